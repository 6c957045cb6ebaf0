"""Checks of libraries and read sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import valid_alphabet
from .ordinals import dense_ordinal


def check_alphabet(library: DataFrame) -> DataFrame:
    return library.select("design_idx", valid_alphabet(F.col("sequence")).alias("valid"))


def repeated_values(library: DataFrame, column: str = "sequence") -> DataFrame:
    """Every occurrence of a value after its first, with its 1-based ordinal among non-blank ones.

    First occurrences are found by one aggregation over the numbered rows and
    subtracted from them, so a value most rows share is never gathered in one
    place: only the first ordinals (one per value) are compared by design.
    """
    rows = library.where(F.length(column) > 0).select("design_idx", column)
    numbered = dense_ordinal(rows, "design_idx", "ordinal")
    firsts = numbered.groupBy(column).agg(F.min("design_idx").alias("design_idx")).select("design_idx")
    return numbered.join(firsts, "design_idx", "left_anti").select("design_idx", "ordinal", column)


def insert_overlap(len1: Column, len2: Column, design_len: Column, barcode_len: Column) -> Column:
    """Nucleotides by which two mates overlap over an insert; 12 are needed to merge them."""
    return len1 + len2 - (design_len + barcode_len)


def length_cutoff(library: DataFrame) -> DataFrame:
    """One row: 92 % of the shortest design, rounded down."""
    return library.agg(F.floor(F.min(F.length("sequence")) * F.lit(0.92)).cast("int").alias("cutoff"))
