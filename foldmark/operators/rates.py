"""Mutation rates per position, and their re-aggregation through counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MISMATCHES, MUT_TYPES, MUTS
from .reactivity import ratio


def position_rates(counts: DataFrame) -> DataFrame:
    """Per (pos, tag, measure): summed counts over summed coverage of all designs.

    Holds the 14 mutation types and, as measure ``muts``, the counter's own
    total. Designs are summed away first; what is left is positions x measures.
    """
    sums = counts.groupBy("pos", "tag", "measure").agg(F.sum("n").alias("n"))
    cell = Window.partitionBy("pos", "tag")
    c = F.max(F.when(F.col("measure") == COVERAGE, F.col("n"))).over(cell)
    return sums.withColumn("coverage", c).where(F.col("measure") != COVERAGE).select(
        "pos", "tag", "measure", ratio(F.col("n"), F.col("coverage")).alias("rate"), "coverage"
    )


def rate_matrix(counts: DataFrame) -> DataFrame:
    """Per (pos, tag, measure): the rates of all mutation types wherever there is coverage, zeros included.

    Unlike ``position_rates``, every type has a row, so that rates of several
    tags or sets can be re-aggregated: a type nobody counted still has its
    coverage. The counter's own total is there where it was counted. One
    aggregation with partial sums; what is left is positions x tags.
    """
    measures = [COVERAGE, *MUT_TYPES, MUTS]
    cells = counts.groupBy("pos", "tag").agg(*[F.sum(F.when(F.col("measure") == m, F.col("n"))).alias(m) for m in measures])
    sums = [(t, F.coalesce(F.col(t), F.lit(0))) for t in MUT_TYPES] + [(MUTS, F.col(MUTS))]
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("measure"), n.cast("bigint").alias("n")) for t, n in sums]))
    return cells.where(F.col(COVERAGE).isNotNull()).select("pos", "tag", COVERAGE, each.alias("x")).where("x.n IS NOT NULL").select(
        "pos", "tag", "x.measure", ratio(F.col("x.n"), F.col(COVERAGE)).alias("rate"), COVERAGE
    )


def coverage_by_position(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("measure") == COVERAGE).groupBy("pos", "tag").agg(F.sum("n").alias("coverage"))


def reaggregate_rates(rates: DataFrame, by: list[str]) -> DataFrame:
    """Coverage-weighted rates of merged tags or concatenated sets.

    A missing rate counts as zero mutations. ``by`` are the key columns the
    merged rows share.
    """
    return rates.groupBy(*by).agg(
        F.sum(F.coalesce("rate", F.lit(0.0)) * F.col("coverage")).alias("_m"),
        F.sum("coverage").alias("coverage"),
    ).select(*by, F.try_divide("_m", "coverage").alias("rate"), "coverage")


def mean_rates_by_type(rates: DataFrame, length: int, blank5: int = 0, blank3: int = 0) -> DataFrame:
    """Unweighted mean rate over un-blanked positions, per tag and measure.

    Positions where nothing was counted for a covered measure are zeros, so
    the mean divides by the number of covered positions.
    """
    inner = rates.where((F.col("pos") > blank5) & (F.col("pos") <= length - blank3))
    covered = inner.where(F.col("coverage") > 0).groupBy("tag").agg(F.count_distinct("pos").alias("k"))
    sums = inner.groupBy("tag", "measure").agg(F.sum("rate").alias("s"))
    return sums.join(F.broadcast(covered), "tag").select(
        "tag", "measure", F.try_divide("s", "k").alias("mean_rate")
    )


def rate_summary(means: DataFrame) -> DataFrame:
    """Per tag: strict mismatches, insertions, deletions, strict + deletions, counter's total."""
    m, v = F.col("measure"), F.col("mean_rate")

    def total(test):
        return F.coalesce(F.sum(F.when(test, v)), F.lit(0.0))

    return means.where(m.isin([*MUT_TYPES, MUTS])).groupBy("tag").agg(
        total(m.isin(list(MISMATCHES))).alias("mut"), total(m == "ins").alias("ins"),
        total(m == "del").alias("del"), total(m.isin([*MISMATCHES, "del"])).alias("mut_del"),
        total(m == MUTS).alias("counted"),
    )
