"""Normalization set, 90th-percentile values, blanking and renormalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    COVERAGE, FIVE_PRIME_ENDS, NORM_CUTOFFS, NORM_MIN_HITS, THREE_PRIME_ENDS,
)
from .ordinals import dense_ordinal, nearest_rank


def coverage_by_tag(counts: DataFrame) -> DataFrame:
    """Deepest position of each design and tag."""
    return counts.where(F.col("measure") == COVERAGE).groupBy("design_idx", "tag").agg(
        F.max("n").alias("coverage")
    )


def total_coverage(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("design_idx").agg(F.sum("coverage").alias("total_coverage"))


def coverage_cutoff(totals: DataFrame, cutoffs=NORM_CUTOFFS, min_hits: int = NORM_MIN_HITS) -> DataFrame:
    """One row: the first cutoff at least ``min_hits`` designs exceed, or -1 for all designs."""
    hits = {c: F.count_if(F.col("total_coverage") > c) for c in cutoffs}
    pick = F.lit(-1)
    for c in reversed(cutoffs):
        pick = F.when(hits[c] >= min_hits, F.lit(c)).otherwise(pick)
    return totals.agg(pick.alias("cutoff"))


def passing_designs(totals: DataFrame, cutoffs=NORM_CUTOFFS, min_hits: int = NORM_MIN_HITS) -> DataFrame:
    """Designs above the cutoff the cascade settles on."""
    cutoff = coverage_cutoff(totals, cutoffs, min_hits).scalar()
    return totals.where(F.col("total_coverage") > cutoff)


def normalization_set(totals: DataFrame, max_sequences: int | None = None,
                      cutoffs=NORM_CUTOFFS, min_hits: int = NORM_MIN_HITS) -> DataFrame:
    """Designs used to normalize: all above the cutoff; with ``max_sequences``, every stride-th when there are many.

    Only passing designs are numbered, and only with ``max_sequences``; the
    result then has fewer than twice as many rows.
    """
    passing = passing_designs(totals, cutoffs, min_hits).select("design_idx", "total_coverage")
    if max_sequences is None:
        return passing
    ranked = dense_ordinal(passing, "design_idx", "_rank")
    n = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    stride = F.when(n > max_sequences, F.floor(n / max_sequences)).otherwise(1).cast("bigint")
    return ranked.where(F.col("_rank") % stride == 0).drop("_rank")


def blank_ends(rows: DataFrame, blank5: int, blank3: int, columns: list[str]) -> DataFrame:
    """Missing values in the first ``blank5`` and last ``blank3`` positions of each design."""
    keep = (F.col("pos") > blank5) & (F.col("pos") <= F.col("seq_len") - blank3)
    return rows.withColumns({c: F.when(keep, F.col(c)) for c in columns})


def auto_blank_ends(sequence: Column) -> tuple[Column, Column]:
    """End lengths recognised from the first design's constant flanks."""
    rna = F.translate(sequence, "T", "U")

    def pick(flanks, test):
        out = F.lit(0)
        for flank, size in reversed(flanks):
            out = F.when(test(rna, flank) & (F.length(rna) > size), F.lit(size)).otherwise(out)
        return out

    return (
        pick(FIVE_PRIME_ENDS, lambda s, x: s.startswith(x)),
        pick(THREE_PRIME_ENDS, lambda s, x: s.endswith(x)),
    )


def norm_values(rows: DataFrame, norm_set: DataFrame | None = None, value: str = "r",
                by: tuple[str, ...] = ("cond_idx",)) -> DataFrame:
    """Nearest-rank 90th percentile over the normalization set, per condition.

    ``rows`` have blanked ends. Without ``norm_set`` they are taken to be
    restricted to it already.
    """
    if norm_set is not None:
        rows = rows.join(norm_set.select("design_idx"), "design_idx", "left_semi")
    return nearest_rank(rows, list(by), value, "norm_val")


def normalize(rows: DataFrame, values: DataFrame, columns: list[str],
              by: tuple[str, ...] = ("cond_idx",)) -> DataFrame:
    """Divide ``columns`` by the norm value; one value per condition (and base)."""
    joined = rows.join(F.broadcast(values), list(by), "left")
    return joined.withColumns({c: F.try_divide(F.col(c), F.col("norm_val")) for c in columns})


def denormalize(rows: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """Undo ``normalize`` so that values from different sets can be compared."""
    joined = rows.join(F.broadcast(values), "cond_idx", "left")
    return joined.withColumns({c: F.col(c) * F.col("norm_val") for c in columns}).drop("norm_val")
