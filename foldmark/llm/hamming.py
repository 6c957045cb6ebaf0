"""Exact top-k search over binary codes: multi-index hashing with growing segment radii."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A code is cut into so many segments of 16 bits.
SEGMENTS, SEGMENT_BITS = 4, 16
SHARD_ROWS, BLOCK_QUERIES = 65_536, 8_192
#: Pairs of query and code that are verified together.
MOST_HITS = 2_000_000

RESULT = "query_id bigint, vec_id bigint, distance bigint"


def sign_code(vector: Column, bits: int = 64) -> Column:
    """A 64-bit code with one bit per component: is it positive? The first component is the highest bit.

    Null where the vector is null, has another size, or holds null or
    non-finite components.
    """
    sound = (F.size(vector) == bits) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    code = F.aggregate(
        vector, F.lit(0).cast("bigint"),
        lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")),
    )
    return F.when(sound, code)


def flips(radius: int) -> np.ndarray:
    """Masks of a segment that have exactly ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT_BITS), radius)], np.uint16)


def segments(codes: np.ndarray) -> np.ndarray:
    return codes.astype("<u8").view("<u2").reshape(-1, SEGMENTS)


class Index:
    """Distinct codes of one shard, by the value of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = segments(codes)
        self.order = [np.argsort(self.parts[:, s], kind="stable") for s in range(SEGMENTS)]
        self.starts = [
            np.concatenate([[0], np.cumsum(np.bincount(self.parts[:, s], minlength=1 << SEGMENT_BITS))]) for s in range(SEGMENTS)
        ]

    def at(self, segment: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``values``, code) of all codes that have one of the values in the segment."""
        first = self.starts[segment][values]
        size = self.starts[segment][values.astype(np.int64) + 1] - first
        who = np.repeat(np.arange(len(values)), size)
        inner = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size)
        return who, self.order[segment][first[who] + inner]


def search(index: Index, weights: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, code, distance) with, for each query, all codes up to its k-th nearest row.

    ``weights`` says how many rows a code stands for. Queries go in groups for
    which all codes would fit: where most codes share a segment, each query
    meets nearly all of them at once.
    """
    step = max(1, MOST_HITS // max(1, len(index.codes)))
    parts = [_search_some(index, weights, queries[a : a + step], k) for a in range(0, len(queries), step)]
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    who = np.concatenate([w + i * step for i, (w, _, _) in enumerate(parts)])
    return who, *(np.concatenate([p[c] for p in parts]) for c in (1, 2))


def _search_some(index: Index, weights: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """After radius r every code within SEGMENTS * (r + 1) - 1 bits has been verified: it differs by at most r bits in
    some segment. A query is done once that covers its k-th row. A code is verified only where it is met first, so none
    is counted twice, and what lies behind the k-th row is left out.
    """
    open_, out = np.arange(len(queries)), []
    counts = np.zeros((len(queries), 64 + 2), np.int64)
    for radius in range(SEGMENT_BITS + 1):
        if not len(open_):
            break
        masks = flips(radius)
        own = segments(queries[open_])
        for s in range(SEGMENTS):
            step = max(1, MOST_HITS // len(masks))
            for a in range(0, len(open_), step):
                values = (own[a : a + step, s][:, None] ^ masks[None, :]).ravel()
                who, code = index.at(s, values)
                who = open_[a + who // len(masks)]
                apart = np.bitwise_count(segments(queries[who] ^ index.codes[code]))
                order = apart.astype(np.int16) * SEGMENTS + np.arange(SEGMENTS, dtype=np.int16)
                fresh = order.min(axis=1) == radius * SEGMENTS + s
                who, code, distance = who[fresh], code[fresh], apart[fresh].sum(axis=1, dtype=np.int64)
                np.add.at(counts, (who, distance), weights[code])
                out.append(np.stack([who, code, distance], axis=1))
        covered = SEGMENTS * (radius + 1) - 1
        open_ = open_[counts[open_, : covered + 1].sum(axis=1) < k]
    found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    upto = np.cumsum(counts, axis=1) >= k
    last = np.where(upto[:, -1], upto.argmax(axis=1), counts.shape[1])
    found = found[found[:, 2] <= last[found[:, 0]]]
    return found[:, 0], found[:, 1], found[:, 2]


def _shard_search(k: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "distance": []})
        code, ident = rows["code"].to_numpy(np.int64).view(np.uint64), rows["vec_id"].to_numpy(np.int64)
        order = np.lexsort((ident, code))
        code, ident = code[order], ident[order]
        codes, first, size = np.unique(code, return_index=True, return_counts=True)
        qid = asked["query_id"].to_numpy(np.int64)
        qcode = asked["code"].to_numpy(np.int64).view(np.uint64)
        # One row more than asked for: the query's own may be among them.
        size = np.minimum(size, k + 1)
        who, at, distance = search(Index(codes), size, qcode, k + 1)
        n = size[at]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = ident[np.repeat(first[at], n) + inner]
        who, distance = np.repeat(who, n), np.repeat(distance, n)
        keep = found != qid[who]
        who, found, distance = who[keep], found[keep], distance[keep]
        order = np.lexsort((found, distance, who))
        who, found, distance = who[order], found[order], distance[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who, side="left")
        top = rank < k
        return pd.DataFrame({"query_id": qid[who[top]], "vec_id": found[top], "distance": distance[top]})

    return run


def top_k(codes: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", code_col: str = "code",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k nearest rows of every query by Hamming distance: query_id, rank, vec_id, distance.

    Exact; ties go to the smaller id, and a query's own id is no candidate. Ids
    are taken to be unique; equal rows repeated are one row. Rows and queries
    meet in blocks of bounded size: a shard of rows is indexed once per block of
    queries, and only k rows per query and shard leave it. Equal codes, however
    many, are one entry of the index, of which k + 1 ids can matter. Rows with a
    null id or code take no part; fewer than k rows give fewer.
    """
    rows = codes.select(codes[id_col].cast("bigint").alias("vec_id"), codes[code_col].cast("bigint").alias("code"))
    rows = rows.where("vec_id is not null and code is not null").distinct()
    asked = queries.select(queries[id_col].cast("bigint").alias("query_id"), queries[code_col].cast("bigint").alias("code"))
    asked = asked.where("query_id is not null and code is not null").distinct()
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))

    def pieces(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", pieces(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("shard", pieces(shards))
    near = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(_shard_search(k), RESULT)
    # Every task sends on k rows for each query, whatever the number of shards.
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "distance")
