"""Summing counts over splits and lanes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE

CELL = ["design_idx", "pos", "tag", "measure"]


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Element-wise sum of counts; a cell absent from a part counts as zero.

    Sums are combined before the shuffle, so the number of splits does not
    grow what is exchanged beyond one row per cell and task.
    """
    rows = reduce(DataFrame.unionByName, [p.select(*CELL, "n") for p in parts])
    return rows.groupBy(*CELL).agg(F.sum("n").alias("n"))


def design_range(df: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Designs first..last, inclusive and 1-based; one number means 1..n."""
    if last is None:
        first, last = 1, first
    return df.where(F.col("design_idx").between(first, last))


def range_label(chunk: int) -> Column:
    """First design of the chunk of ``chunk`` designs a row belongs to."""
    return (F.floor((F.col("design_idx") - 1) / F.lit(chunk)) * chunk + 1).cast("bigint")


def total_counts(counts: DataFrame, measure: str = COVERAGE) -> DataFrame:
    """Per tag: sum over designs of the deepest position."""
    deepest = counts.where(F.col("measure") == measure).groupBy("tag", "design_idx").agg(F.max("n").alias("top"))
    return deepest.groupBy("tag").agg(F.sum("top").alias("total"))


def total_tensor_counts(tensor: DataFrame) -> DataFrame:
    """Per tag: sum over designs, reference and read letters of the deepest position.

    The tensor layout's total differs from ``total_counts`` on purpose; its
    insertions are kept apart and do not enter.
    """
    deepest = tensor.where(F.col("read") != "ins").groupBy("tag", "design_idx", "ref", "read").agg(F.max("n").alias("top"))
    return deepest.groupBy("tag").agg(F.sum("top").alias("total"))


def tensor_to_measures(tensor: DataFrame) -> DataFrame:
    """Reference/read tensor to measures: 12 mismatches, del, ins, coverage and muts.

    Coverage is every cell except insertions' own; muts are mismatches and
    deletions; matches (ref = read) only add to coverage. Each tensor cell
    feeds at most three measures, so it is expanded once and summed.
    """
    ref, read = F.col("ref"), F.col("read")
    mismatch = (ref != read) & ~read.isin("del", "ins")
    kind = F.when(read.isin("del", "ins"), read).when(mismatch, F.concat(ref, read))
    measures = F.array_compact(F.array(
        kind,
        F.when(read != "ins", F.lit(COVERAGE)),
        F.when(mismatch | (read == "del"), F.lit("muts")),
    ))
    return tensor.select("design_idx", "pos", "tag", F.explode(measures).alias("measure"), "n").groupBy(*CELL).agg(
        F.sum("n").alias("n")
    )

