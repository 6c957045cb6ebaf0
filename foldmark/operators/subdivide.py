"""Sub-libraries named in design headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNASSIGNED = "unassigned"


def sublibrary(header: Column) -> Column:
    """Text after ``sublibrary:`` up to a comma, space or tab; ``unassigned`` without one."""
    return F.coalesce(F.nullif(F.regexp_extract(header, r"sublibrary:([^, \t]*)", 1), F.lit("")), F.lit(UNASSIGNED))


def sublibrary_sizes(library: DataFrame) -> DataFrame:
    """Designs per sub-library and the first of them, which gives the listing order."""
    return library.groupBy(sublibrary(F.col("header")).alias("sublibrary")).agg(
        F.count("*").alias("designs"), F.min("design_idx").alias("first_design")
    )


def split_counts(counts: DataFrame, library: DataFrame) -> DataFrame:
    """Counts with the sub-library of their design, ready for a partitioned write."""
    names = library.select("design_idx", sublibrary(F.col("header")).alias("sublibrary"))
    return counts.join(names, "design_idx")


def restrict_to(counts: DataFrame, designs: DataFrame) -> DataFrame:
    """Counts of the given designs only."""
    return counts.join(designs.select("design_idx"), "design_idx", "left_semi")


def headers_with(library: DataFrame, text: str) -> DataFrame:
    return library.where(F.contains("header", F.lit(text)))
