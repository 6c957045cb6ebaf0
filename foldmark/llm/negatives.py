"""Hard negatives by segment summaries: bounds on inner products decide which rows are scored."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .vectors import finite, lists, matrix, usual_size

#: Components per segment, level by level, from coarse to fine; each is a multiple of the next.
SEGMENT_SIZES = (16, 4, 2)
#: Rows of a shard, anchors of a block, pairs of anchor and row that one step holds.
SHARD_ROWS, BLOCK_ANCHORS, STEP_PAIRS = 16_384, 8_192, 1 << 20
#: Integer components beyond this are cut to it, so that no score leaves 64 bits.
LARGEST = 1 << 25

_INDEX = "vec_id bigint, label int, anchor boolean, code array<bigint>, means array<double>, deviations array<double>"
_HITS = "anchor_id bigint, slot int, vec_id bigint, score bigint"
_NO_LIMIT = 1 << 62


def summaries(codes: np.ndarray, size: int = SEGMENT_SIZES[-1]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (root of the summed squares) of each segment of ``size`` components; zeros fill the last."""
    filled = np.pad(codes.astype(np.float64), ((0, 0), (0, -codes.shape[1] % SEGMENT_SIZES[0])))
    parts = filled.reshape(len(codes), -1, size)
    means = parts.mean(axis=2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))


def coarser(means: np.ndarray, deviations: np.ndarray, size: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments of ``times`` segments of ``size`` components each, from theirs."""
    grouped = means.reshape(len(means), -1, times)
    joint = grouped.mean(axis=2)
    spread = (deviations ** 2).reshape(len(means), -1, times).sum(axis=2) + size * ((grouped - joint[:, :, None]) ** 2).sum(axis=2)
    return joint, np.sqrt(spread)


class Side:
    """Vectors with what is stored of their segments: for each level, means (times the root of the size) and deviations."""

    def __init__(self, codes: np.ndarray, means: np.ndarray, deviations: np.ndarray):
        finest = SEGMENT_SIZES[-1]
        self.codes, self.levels = codes, []
        for size in SEGMENT_SIZES:
            m, d = coarser(means, deviations, finest, size // finest) if size > finest else (means, deviations)
            self.levels.append((m * np.sqrt(size), d))
        self.exact = codes.astype(np.float64)
        self.most = float(np.abs(self.exact).max(initial=0))
        self.norms = np.sqrt((self.exact ** 2).sum(axis=1))

    def part(self, rows: slice) -> Side:
        own = object.__new__(Side)
        own.codes, own.exact, own.norms, own.most = self.codes[rows], self.exact[rows], self.norms[rows], self.most
        own.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return own


def _products(left: np.ndarray, right: np.ndarray, who: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Inner products of pairs: one matrix product where a good part of all pairs is asked for."""
    if 6 * len(who) > len(left) * len(right) and left.dtype == np.float64:
        return (left @ right.T)[who, at]
    out = np.empty(len(who), left.dtype)
    for a in range(0, len(who), 65_536):
        own = slice(a, a + 65_536)
        out[own] = np.einsum("ij,ij->i", left[who[own]], right[at[own]])
    return out


def bounds(anchors: Side, rows: Side, level: int, who: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the pairs' inner products; past the last level, the exact ones twice.

    In each segment the product is size * mean * mean plus the product of what
    is left after the means, which is no more than the deviations' product.
    """
    if level == len(SEGMENT_SIZES):
        small = anchors.most * rows.most * anchors.codes.shape[1] < 1 << 53
        pick = (lambda side: side.exact) if small else (lambda side: side.codes)
        exact = _products(pick(anchors), pick(rows), who, at)
        return exact, exact
    (am, ad), (rm, rd) = anchors.levels[level], rows.levels[level]
    middle, reach = _products(am, rm, who, at), _products(ad, rd, who, at)
    reach += 0.25 + 1e-9 * anchors.norms[who] * rows.norms[at]  # rounding
    return middle - reach, middle + reach


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf where fewer than k are finite."""
    out = np.full(len(values), -np.inf)
    enough = np.flatnonzero((values > -np.inf).sum(axis=1) >= k)
    if len(enough):
        out[enough] = np.partition(values[enough], values.shape[1] - k, axis=1)[:, values.shape[1] - k]
    return out


def banded_top(anchors: Side, rows: Side, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple]:
    """For each column of ``low`` and ``high``: (anchor, row, score) of at least each anchor's k largest scores in its band.

    ``allowed`` says which pairs count. Level by level, a pair goes once its
    bounds leave every band, or k pairs are sure to be inside and above it.
    """
    alive = allowed
    for level in range(len(SEGMENT_SIZES) + 1):
        who, at = np.nonzero(alive)
        least, most = np.full(alive.shape, -np.inf), np.full(alive.shape, -np.inf)
        least[who, at], most[who, at] = bounds(anchors, rows, level, who, at)
        still = np.zeros_like(alive)
        for lo, hi in zip(low.T[:, :, None], high.T[:, :, None]):
            inside = alive & (least >= lo) & (most <= hi)
            sure = _kth(np.where(inside, least, -np.inf), k)[:, None]
            still |= alive & (most >= np.maximum(lo, sure)) & (least <= hi)
        alive = still
    for lo, hi in zip(low.T[:, :, None], high.T[:, :, None]):
        who, at = np.nonzero(alive & (least >= lo) & (least <= hi))
        yield who, at, least[who, at]


def _side(table: pa.Table) -> Side:
    return Side(matrix(table["code"]), matrix(table["means"]), matrix(table["deviations"]))


def _bands(scores: pa.ChunkedArray, percents: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score of each anchor's slots: the percents of its positives' scores, or no limit at all."""
    if percents is None:
        return np.full((len(scores), 1), -_NO_LIMIT), np.full((len(scores), 1), _NO_LIMIT)
    known = scores.to_pylist()
    low = np.full((len(known), max(map(len, known))), _NO_LIMIT)
    high = -low
    for i, own in enumerate(known):
        own = np.array(own, np.int64)
        low[i, : len(own)], high[i, : len(own)] = -(-own * percents[0] // 100), own * percents[1] // 100
    return low, high


def _search(k: int, percents: tuple[int, int] | None):
    """Hits in a shard: of the anchor's label without any limit, or, where percents are given, of others in the bands."""
    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        if index.num_rows and asked.num_rows:
            rows, anchors = _side(index), _side(asked)
            ids, labels = index["vec_id"].to_numpy(), index["label"].to_numpy()
            own, own_labels = asked["anchor_id"].to_numpy(), asked["label"].to_numpy()
            low, high = _bands(asked["scores"], percents)
            step = max(1, STEP_PAIRS // len(ids))
            for a in range(0, len(own), step):
                part = slice(a, a + step)
                fits = (labels == own_labels[part, None]) == (percents is None)
                fits &= ids != own[part, None]
                bands = banded_top(anchors.part(part), rows, fits, low[part].astype(float), high[part].astype(float), k)
                for slot, (who, at, score) in enumerate(bands):
                    order = np.lexsort((ids[at], -score, who))
                    who, at, score = who[order], at[order], score[order]
                    top = np.arange(len(who)) - np.searchsorted(who, who) < k
                    for out, new in zip(found, (own[part][who[top]], np.full(top.sum(), slot), ids[at[top]], score[top])):
                        out.append(new)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["anchor_id", "slot", "vec_id", "score"]
        return pa.table([pa.array(np.concatenate(f).astype(np.int64) if f else [], t) for f, t in zip(found, kinds)], names=names)

    return run


def _indexed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            codes = matrix(batch.column("code"))
            columns = [*(batch.column(c) for c in ("vec_id", "label", "anchor")), lists(codes), *map(lists, summaries(codes))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "anchor", "code", "means", "deviations"])


def _top(index: DataFrame, asked: DataFrame, k: int, percents: tuple[int, int] | None, shards: int, blocks: int) -> DataFrame:
    """The first k hits of every anchor and slot, with their rank. Of what tasks find, each sends on k rows per slot."""
    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = index.drop("anchor").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("anchor_id", F.lit(7)), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    hits = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_search(k, percents), _HITS)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """For every anchor and each of its nearest rows of the same label, the nearest rows of other labels within a band.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    Components become floor(scale * x) as integers, scores are their exact
    inner products, higher first, ties by the smaller id. A negative's score is
    from ``low_percent`` to ``high_percent`` of its positive's. Both searches
    are exact: they leave out rows whose bounds, from the stored means and
    deviations of their segments, shut them out, and score the rest.

    Every row meets every anchor's bounds, in blocks: shards of rows, dealt by
    a hash of the id, so that no label or copy makes one large, by blocks of
    anchors. The row side is shuffled once for each block of anchors (each
    such row then meets 8 192 of them), and a task's memory is bounded by both.

    Rows without an id, a label or a vector, with null or non-finite components
    or of another size than most take no part; zero vectors do. Of rows that
    share an id one counts, chosen by a hash of the row. Components beyond 2**25
    after scaling count as that. Fewer rows than asked for give fewer, and an
    anchor without positives gives none.
    """
    vector = rows[vector_col].cast("array<double>")
    named = rows.select(rows[id_col].cast("bigint").alias("vec_id"), rows[label_col].cast("int").alias("label"), vector.alias("vector"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    named = named.where("vec_id is not null and label is not null and vector is not null")
    size = usual_size(named, F.col("vector"))
    integer = F.transform("vector", lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("bigint"))
    whole = named.where(finite(F.col("vector"), size)).select("vec_id", F.struct("label", integer.alias("code"), "anchor").alias("row"))
    single = whole.groupBy("vec_id").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("vec_id", "row.*")
    index = written(single.select("vec_id", "label", "anchor", "code").mapInArrow(_indexed, _INDEX), "segments")
    anchors = written(index.where("anchor").drop("anchor").withColumnRenamed("vec_id", "anchor_id"), "anchors")
    shards, blocks = max(1, -(-index.count() // shard_rows)), max(1, -(-anchors.count() // block_anchors))

    near = written(_top(index, anchors.withColumn("scores", F.array().cast("array<bigint>")), positives, None, shards, blocks), "positives")
    first = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))

    asked = anchors.join(first, "anchor_id").withColumn("scores", F.transform("near", lambda x: x["score"])).drop("near")
    found = _top(index, asked, negatives, (low_percent, high_percent), shards, blocks)
    near = near.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(near, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
