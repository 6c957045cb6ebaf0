"""SimHash near-duplicates: fingerprints linked by hashing the balls around their halves."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .batches import keyed_texts, raw_texts, text_slices
from .components import components

#: Fingerprints linked by at most so many differing bits.
RADIUS = 3
#: With up to so many fingerprints at home in a variant all others there are compared; larger groups go the exact long way.
COMPARED = 64

_BITS = np.arange(32, dtype=np.uint64)
_ONE = np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bits set in over half the 64-bit hashes of all word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) > shingle:
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = ends - sizes + 1
        hashes = [xxhash.xxh64_intdigest(line[a:z], seed) for a, z in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    packed = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(packed), 1 << 16):
        ones += np.unpackbits(packed[a : a + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(packed), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as a bigint) of every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = np.array([fingerprint(t, shingle, seed) for t in raw_texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fingerprint bigint")


def _half(codes: np.ndarray, half: int) -> np.ndarray:
    return codes >> np.uint64(32) if half else codes & _LOW


def _emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Variants of both halves: (key: half and variant, fingerprint, is it away from its own half).

    Two fingerprints within three bits differ by at most one bit in one of
    their halves. A half with an even number of ones emits itself; one with an
    odd number emits itself and all its neighbours, which are even. So equal
    halves meet at themselves, and halves one bit apart at the even one.
    """
    for batch in batches:
        codes = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            own = _half(codes, half)
            odd = np.bitwise_count(own) % 2 == 1
            around = (own[odd][:, None] ^ (_ONE << _BITS)[None, :]).ravel()
            keys = np.concatenate([own, around]) | np.uint64(half << 32)
            of = np.concatenate([codes, np.repeat(codes[odd], 32)])
            away = np.concatenate([np.zeros(len(own), np.int32), np.ones(len(around), np.int32)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(of.view(np.int64)), pa.array(away)], names=["key", "code", "away"])


def _met_first(a: np.ndarray, b: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Pairs within the radius, each only at the first half where it meets."""
    low = np.bitwise_count(_half(a ^ b, 0))
    high = np.bitwise_count(_half(a ^ b, 1))
    return (low + high <= RADIUS) & np.where(half == 0, low <= 1, (low > 1) & (high <= 1))


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups with few members at home, and all members of the others, from rows sorted by (key, away).

    Every member of a group is compared with those at home (two that are both
    away differ by two bits here and meet elsewhere). Members at home come
    first, so only those few are carried from one batch to the next.
    """
    rest = np.zeros(0, np.uint64)
    last, large = None, False
    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
        code = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
        home = batch.column("away").to_numpy(zero_copy_only=False) == 0
        if not len(key):
            continue
        goes_on = last is not None and key[0] == last
        if goes_on and not large:
            key = np.concatenate([np.full(len(rest), last), key])
            code, home = np.concatenate([rest, code]), np.concatenate([np.ones(len(rest), bool), home])
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        homes = np.add.reduceat(home.astype(np.int64), starts)
        big = homes > COMPARED
        big[0] |= goes_on and large
        of = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(key)) - starts[of]
        half = (key >> np.uint64(32)).astype(np.int64)
        small_homes = np.where(big, 0, homes)
        edge_a, edge_b = [], []
        for j in range(int(small_homes.max())):
            at = np.flatnonzero((small_homes[of] > j) & (place > j))
            a, b = code[starts[of[at]] + j], code[at]
            linked = _met_first(a, b, half[at]) & (a != b)
            edge_a.append(a[linked])
            edge_b.append(b[linked])
        hot = big[of]
        a = np.concatenate([np.zeros(0, np.uint64), *edge_a, key[hot]])
        b = np.concatenate([np.zeros(0, np.uint64), *edge_b, code[hot]])
        kind = np.zeros(len(a), np.int32)
        kind[len(a) - int(hot.sum()) :] = 1
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])
        last, large = key[-1], bool(big[-1])
        rest = code[starts[-1] : starts[-1] + (0 if large else homes[-1])]


def _meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For members of large groups, all variants of the other half: within one bit, or of exactly two (role 1).

    Members whose own half is the key ("at home") are linked if their other
    halves differ by at most three bits, so one emits its variants within two
    bits, and the other those within one. A neighbour has spent one bit
    already and emits only its variants within one (role 2).
    """
    pairs = np.array([(1 << i) | (1 << j) for i in range(32) for j in range(i)], np.uint64)
    near = np.concatenate([np.zeros(1, np.uint64), _ONE << _BITS])
    for batch in batches:
        keys = batch.column("a").to_numpy(zero_copy_only=False).view(np.uint64)
        codes = batch.column("b").to_numpy(zero_copy_only=False).view(np.uint64)
        for a in range(0, len(keys), 4096):
            key, code = keys[a : a + 4096], codes[a : a + 4096]
            half = (key >> np.uint64(32)).astype(np.int64)
            own = np.where(half == 1, _half(code, 1), _half(code, 0))
            other = np.where(half == 1, _half(code, 0), _half(code, 1))
            home = own == key & _LOW
            for who, masks, role in ((home, near, 0), (home, pairs, 1), (~home, near, 2)):
                n = int(who.sum())
                if n:
                    at = (other[who][:, None] ^ masks[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(key[who], len(masks)).view(np.int64)), pa.array(at.view(np.int64)),
                         pa.array(np.repeat(code[who], len(masks)).view(np.int64)), pa.array(np.full(n * len(masks), role, np.int32))],
                        names=["key", "at", "code", "role"],
                    )


def links(codes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints within three bits, enough to connect all that are linked.

    ``codes`` has one row per distinct ``fingerprint``. Each emits 1 or 33
    variants per half, which are shuffled. In a group of a variant all are
    verified against the few at home, each pair at one place only. In a large group
    nobody is compared with everybody: its members meet again at variants of
    the other half, where whoever comes from within one bit is within the
    radius of all that meet there, and a link to one such fingerprint stands
    for all. Such a meeting holds at most 33 + 496 + 1056 fingerprints.
    """
    emitted = codes.select("fingerprint").mapInArrow(_emit, "key bigint, code bigint, away int")
    met = emitted.repartition("key").sortWithinPartitions("key", "away").mapInArrow(_compare, "kind int, a bigint, b bigint")
    met = written(met, "met")
    direct = met.where("kind = 0").select("a", "b")
    hot = met.where("kind = 1").select("a", "b").mapInArrow(_meet, "key bigint, at bigint, code bigint, role int")
    centre = hot.groupBy("key", "at").agg(
        F.min(F.when(F.col("role") == 0, F.col("code"))).alias("centre"), F.collect_set("code").alias("codes"),
    ).where("centre is not null and size(codes) > 1")
    far = centre.select(F.col("centre").alias("a"), F.explode("codes").alias("b")).where("a <> b").distinct()
    return direct.unionByName(far)


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id, the smallest doc_id its document reaches over links.

    Equal fingerprints are one node of the link graph, however many documents
    have them. Rows with a null id are fingerprinted and linked, but name no
    component; where all ids of a component are null, so is component_id.
    Repeated rows come back as often; an empty table stays empty.
    """
    prints = written(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = written(components(links(nodes)), "roots")
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"]).select("fingerprint", "first_id", "root")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    moved = rooted.join(smallest, "root").select("fingerprint", "component_id")
    ids = nodes.join(moved, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "first_id").alias("component_id"))
    # Written, so that the last join has plain shuffles at both sides and a fingerprint of very many documents is split.
    ids = written(ids, "classes")
    return prints.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def text_keys(text: Column) -> list[Column]:
    """A 128-bit hash of a text (null: empty), as two longs."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def representatives(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_1 and text_2 (see ``text_keys``) of one document of each component, and how many rows are the same there.

    It is the one with the smallest doc_id, null after all others, and of those
    the one with the smallest hash. Rows that repeat an id count each by its own text.
    """
    first, second = text_keys(docs[text_col])
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       first.alias("text_1"), second.alias("text_2"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = np.array([fingerprint(t, shingle, seed) for t in raw_texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_1", "text_2")), pa.array(found.view(np.int64))],
                names=["doc_id", "text_1", "text_2", "fingerprint"])

    prints = rows.mapInArrow(run, "doc_id bigint, text_1 bigint, text_2 bigint, fingerprint bigint")
    alike = prints.groupBy("fingerprint", "doc_id", "text_1", "text_2").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_1", "text_2", "copies"))
    nodes = written(alike.groupBy("fingerprint").agg(first.alias("first")), "nodes")
    roots = written(components(links(nodes)), "roots")
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select("first", F.coalesce("root", "fingerprint").alias("root"))
    return rooted.groupBy("root").agg(F.min("first").alias("first")).select(*[f"first.{c}" for c in ("doc_id", "text_1", "text_2", "copies")])
