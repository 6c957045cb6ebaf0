"""Near-duplicate vectors: inverted lists with product-quantised residuals, table-lookup distances, exact cosines."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import components
from .vectors import finite, lists, matrix, usual_size

#: Rows the lists and codes are fitted on at most, distinct vectors of a list on average, and lists at most.
SAMPLE_ROWS, LIST_ROWS, MOST_LISTS = 16_384, 512, 1_024
#: Components and codewords of a subspace.
SUBSPACE, CODEWORDS = 8, 256
#: Stored vectors and asking vectors of a list that one task compares, and those asking in one step.
BLOCK_STORED, BLOCK_ASKING, STEP_ASKING = 2_048, 8_192, 128
#: Probed margin in standard deviations of a linked vector's place across the border of two lists.
MARGIN = 2.0

_CODED = "node bigint, copies bigint, unit array<double>, home int, probes array<int>, codes binary, error double"
_LINKS = "node bigint, links bigint, least bigint"


def k_means(points: np.ndarray, k: int, rounds: int = 10, seed: int = 13) -> np.ndarray:
    """At most k centres of the points (of fewer points, the points)."""
    rng = np.random.default_rng(seed)
    centres = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))].astype(np.float64)
    for _ in range(rounds):
        home = nearest_centre(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        size = np.bincount(home, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Quantiser:
    """Coarse centres, one codebook per subspace of the residuals, and how far over a list's border a link may reach."""

    def __init__(self, sample: np.ndarray, count: int, radius: float, list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS):
        self.centres = k_means(sample, max(1, min(most_lists, count // list_rows, len(sample))))
        left = self.parts(sample - self.centres[nearest_centre(sample, self.centres)])
        self.books = np.zeros((left.shape[1], CODEWORDS, SUBSPACE))
        self.books[:] = np.inf  # words that no codebook has
        for m in range(left.shape[1]):
            words = k_means(left[:, m], CODEWORDS)
            self.books[m, : len(words)] = words
        gaps = (self.centres ** 2).sum(axis=1)[:, None] + (self.centres ** 2).sum(axis=1)[None] - 2 * self.centres @ self.centres.T
        self.apart = np.sqrt(np.maximum(gaps, 1e-18))
        # Of the sample's spread, as many directions as would carry it evenly.
        spread = np.linalg.eigvalsh(np.cov(sample.T)) if len(sample) > 1 else np.ones(1)
        directions = max(1.0, spread.sum() ** 2 / max((spread ** 2).sum(), 1e-300))
        self.radius, self.margin = radius, min(radius, MARGIN * radius / np.sqrt(directions))

    @staticmethod
    def parts(points: np.ndarray) -> np.ndarray:
        """Points cut into subspaces; zeros fill the last."""
        return np.pad(points, ((0, 0), (0, -points.shape[1] % SUBSPACE))).reshape(len(points), -1, SUBSPACE)

    def code(self, units: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Home list, lists to probe, codes of the residual, and the length of what the code leaves out."""
        score = (self.centres ** 2).sum(axis=1) - 2 * units @ self.centres.T
        home = score.argmin(axis=1)
        rows = np.arange(len(units))
        over = (score - score[rows, home][:, None]) / (2 * self.apart[home])  # distance to the border with each list
        near = over <= self.margin
        near[rows, home] = True
        left = self.parts(units - self.centres[home])
        codes = np.zeros(left.shape[:2], np.uint8)
        for m, book in enumerate(self.books):
            real = book[np.isfinite(book[:, 0])]
            codes[:, m] = nearest_centre(left[:, m], real)
            left[:, m] -= real[codes[:, m]]
        return home, [np.flatnonzero(n) for n in near], codes, np.sqrt((left ** 2).sum(axis=(1, 2)))

    def candidates(self, asking: np.ndarray, at: int, codes: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asking, stored) pairs of list ``at`` that may be within the radius: distance to the code, less its error."""
        left = self.parts(asking - self.centres[at])
        far = np.zeros((len(asking), len(codes)), np.float32)
        for m, book in enumerate(self.books):
            table = ((left[:, m, None, :] - book[None]) ** 2).sum(axis=2).astype(np.float32)
            far += table[:, codes[:, m]]
        return np.nonzero(far <= ((self.radius + errors + 1e-5) ** 2).astype(np.float32))


class Forest:
    """Classes of nodes 0 to n - 1, each known by its smallest node."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.root, b, a)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _coder(quantiser: Quantiser):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 4_096):
                batch = whole.slice(a, 4_096)
                units = matrix(batch.column("unit"))
                home, probes, codes, error = quantiser.code(units)
                ends = np.cumsum([0] + [len(p) for p in probes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("copies"), lists(units), pa.array(home, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(probes), pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                    names=["node", "copies", "unit", "home", "probes", "codes", "error"])

    return run


def _linker(quantiser: Quantiser, cosine: float):
    """Links of the asking with the stored vectors of one block: per vector, their number and the smallest node of its class."""
    def run(stored: pa.Table, asking: pa.Table) -> pa.Table:
        nodes, links, least = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if stored.num_rows and asking.num_rows:
            at = stored["list"][0].as_py()
            mine, theirs = stored["node"].to_numpy(), asking["node"].to_numpy()
            nodes, place = np.unique(np.concatenate([mine, theirs]), return_inverse=True)
            mine_at, theirs_at = place[: len(mine)], place[len(mine) :]
            units, others = matrix(stored["unit"]), matrix(asking["unit"])
            codes = np.frombuffer(b"".join(stored["codes"].to_pylist()), np.uint8).reshape(len(mine), -1)
            errors, weights, heavy = stored["error"].to_numpy(), stored["copies"].to_numpy(), asking["copies"].to_numpy()
            homes = asking["home"].to_numpy()
            asks = np.zeros((len(mine), len(quantiser.centres)), bool)
            probes = stored["probes"].combine_chunks()
            asks[np.repeat(np.arange(len(mine)), probes.value_lengths().to_numpy()), probes.flatten().to_numpy()] = True
            links, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
            for a in range(0, len(theirs), STEP_ASKING):
                who, to = quantiser.candidates(others[a : a + STEP_ASKING], at, codes, errors)
                who += a
                # A pair is met here and, where the stored vector probes the asking one's list, there: it counts in one place.
                once = np.where(homes[who] == at, theirs[who] < mine[to], ~asks[to, homes[who]] | (at < homes[who]))
                who, to = who[once], to[once]
                for b in range(0, len(who), 1 << 16):
                    i, j = who[b : b + (1 << 16)], to[b : b + (1 << 16)]
                    close = np.einsum("ij,ij->i", others[i], units[j]) >= cosine
                    i, j = i[close], j[close]
                    np.add.at(links, theirs_at[i], weights[j])
                    np.add.at(links, mine_at[j], heavy[i])
                    forest.link(theirs_at[i], mine_at[j])
            met = links > 0
            nodes, links, least = nodes[met], links[met], nodes[forest.root[met]]
        return pa.table([pa.array(x, pa.int64()) for x in (nodes, links, least)], names=["node", "links", "least"])

    return run


def _every(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def near_duplicates(rows: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links (other rows with a cosine of at least ``cosine`` found), component_id, kept.

    Links, never pairs, leave a task: each vector's number of them and the
    smallest vector of its class in the task. Equal vectors are one node, known
    by their smallest id, and count as links of each other.

    A vector is stored in the list of its nearest centre, and asks at every
    list whose border is near enough for a linked vector to lie beyond it: two
    standard deviations of a random direction's part across the border, in as
    many directions as the sample shows. Either vector of a pair can find the
    other. Among probed lists nothing is lost: the looked-up distance is held
    against the radius plus the code's own error, and what is near enough gets
    an exact cosine. Lists are cut into blocks, so that a large one makes more
    tasks, not a larger one. Centres and codebooks (at most 1 024 and 256 per
    eight components) are fitted on at most 16 384 vectors, taken by a hash of
    the vector.

    Every row comes back once. Rows with a null id, or a null or zero vector,
    null or non-finite components or another size than most link with nothing
    and are kept; a null id has a null component. Rows that repeat an id are
    vectors of their own.
    """
    named = rows.select(rows[id_col].cast("bigint").alias("vec_id"), rows[vector_col].cast("array<double>").alias("vector"))
    size = usual_size(named, F.col("vector"))
    # Scaled by the largest component first, so that no square overflows or vanishes.
    largest = F.array_max(F.transform("vector", F.abs))
    scaled = F.transform("vector", lambda x: x / F.col("largest"))
    keys = {"key_1": F.xxhash64("vector"), "key_2": F.xxhash64(F.lit(5), "vector")}
    sound = finite(F.col("vector"), size) & F.exists("vector", lambda x: x != 0) & F.col("vec_id").isNotNull()
    keyed = named.withColumn("sound", sound).withColumns({c: F.when(F.col("sound"), k) for c, k in keys.items()})
    nodes = keyed.where("sound").groupBy(*keys).agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vector").alias("vector"))
    nodes = nodes.withColumn("largest", largest).withColumn("scaled", scaled)
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x)).alias("length")
    nodes = nodes.select("*", length).withColumn("unit", F.transform("scaled", lambda x: x / F.col("length")))
    nodes = written(nodes.select(*keys, "node", "copies", "unit"), "vectors")
    count = nodes.count()
    sample = nodes.orderBy("key_1", "key_2").limit(SAMPLE_ROWS).select("unit").toArrow()
    fitted = matrix(sample["unit"]) if count else np.zeros((1, max(size, 1)))
    quantiser = Quantiser(fitted, count, float(np.sqrt(2 - 2 * cosine)))

    coded = written(nodes.select("node", "copies", "unit").mapInArrow(_coder(quantiser), _CODED), "coded")
    probed = coded.select("node", F.explode("probes").alias("list"))
    # One row per list, at most 1 024: how many blocks of stored and of asking vectors it has.
    parts = probed.groupBy("list").agg(F.count(F.lit(1)).alias("asking")).join(
        coded.groupBy(F.col("home").alias("list")).agg(F.count(F.lit(1)).alias("stored")), "list")
    parts = parts.select("list", F.ceil(F.col("stored") / BLOCK_STORED).cast("int").alias("stored_blocks"),
                         F.ceil(F.col("asking") / BLOCK_ASKING).cast("int").alias("asking_blocks"))
    parts = F.broadcast(written(parts, "lists"))

    def dealt(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        df = df.join(parts, "list").withColumn(own, F.pmod(F.xxhash64("node", F.lit(seed)), F.col(own + "_blocks")).cast("int"))
        df = df.withColumn(other, _every(F.col(other + "_blocks"))).drop("stored_blocks", "asking_blocks")
        return df.toDF(*df.columns)  # both sides come from one table: columns of their own

    stored = dealt(coded.withColumn("list", F.col("home")).drop("home"), "stored", "asking", 1)
    asking = dealt(coded.select("node", "copies", "unit", "home", F.explode("probes").alias("list")), "asking", "stored", 2)
    block = ["list", "stored", "asking"]
    found = stored.groupBy(*block).cogroup(asking.groupBy(*block)).applyInArrow(_linker(quantiser, cosine), _LINKS)
    found = written(found, "found")

    roots = components(found.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select(*keys, "node", "copies").join(linked, "node", "left").join(roots, "node", "left")
    known = written(known.select(*keys, "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                 F.coalesce("root", "node").alias("component_id")), "known")
    # Vectors that more than 1/64 of all rows share are fewer than 64: their rows stay where they are.
    often = F.broadcast(known.where(F.col("copies") * 64 > keyed.count()))
    mine = keyed.where("sound").select("vec_id", *keys)
    single = keyed.where("not sound").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = [df.select("vec_id", "n_links", "component_id") for df in (
        mine.join(often, list(keys)), mine.join(often, list(keys), "left_anti").join(known, list(keys)), single)]
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return out[0].unionByName(out[1]).unionByName(out[2]).select("*", kept)
