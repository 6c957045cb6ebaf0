"""Best-fit packing by minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def fullest(available: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of available lengths, the longest among them, whose sum comes closest to the capacity.

    A bitset holds all sums that can be reached. Each length, the longest
    first, is added in groups of 1, 2, 4, ... copies (shifts of the bitset),
    and the bitsets in front of each group are kept to trace the best sum back.
    """
    first = max(available)
    layers, full = [], (1 << (capacity + 1)) - 1
    reach = 1 << first
    for length in sorted(available, reverse=True):
        left = min(available[length] - (length == first), (capacity - first) // length)
        group = 1
        while left > 0 and not reach >> capacity:
            take = min(group, left)
            layers.append((length, take, reach))
            reach = (reach | reach << (take * length)) & full
            left, group = left - take, group * 2
        if reach >> capacity:
            break
    total = reach.bit_length() - 1
    chosen = {first: 1}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def bin_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, copies of each length in a bin), until all pieces are used.

    What is removed for a bin can be removed again for the next while enough
    copies are left: fewer copies make no fuller bin feasible. Each entry uses
    up the copies of some length but for less than one bin's worth, so the plan
    follows the number of different lengths, not of pieces.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("piece lengths must be from 1 to the capacity")
    plan = []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // c for n, c in chosen.items())
        plan.append((times, chosen))
        for n, c in chosen.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def slots(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each plan entry and length: which ranks of that length it takes, and where they go.

    Sorted by (length, first rank).
    """
    rows, taken, sequence = [], {}, 0
    for times, chosen in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            copies = chosen[length]
            rows.append((length, taken.get(length, 0), copies, sequence, offset))
            taken[length] = taken.get(length, 0) + copies * times
            offset += length * copies
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), table.T.copy()))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces that have ``length``, ``part`` and ``nth`` (see tokens.tokenized_pieces).

    The plan is made from the number of pieces of each length, at most
    ``capacity`` rows, whatever the input; it is the only thing the driver
    sees. Pieces of a length are interchangeable: each gets its global rank, the
    sum of the counts of earlier parts plus its number within its part, and so
    its place. No group of equal lengths is sorted or gathered, so one length
    may hold any share of the rows. ``pieces`` is read twice: pass a written
    table. An empty table stays empty.
    """
    parts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_count"))
    histogram = {int(r[0]): int(r[1]) for r in parts.groupBy("length").agg(F.sum("_count")).collect()}
    places = slots(bin_plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("_base", F.coalesce(F.sum("_count").over(earlier), F.lit(0))).drop("_count")
    ranked = pieces.join(bases, ["part", "length"]).withColumn("_rank", F.col("_base") + F.col("nth"))
    columns = [c for c in pieces.columns if c not in ("part", "nth")]
    schema = pieces.select(*columns).schema.add("sequence_id", LongType()).add("offset", LongType())

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(places["length"], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                at[own] = first[n] + np.searchsorted(places["rank"][first[n] : first[n + 1]], rank[own], side="right") - 1
            behind = rank - places["rank"][at]
            sequence = places["sequence"][at] + behind // places["copies"][at]
            offset = places["offset"][at] + behind % places["copies"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    return ranked.select(*columns, "_rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed training sequences: sequence_id, length and ids (binary, the pieces' ids by their offsets)."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
