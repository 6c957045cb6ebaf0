"""Joins with checked cardinality, and reshaping between long and array form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import design_key
from ..options import Condition
from .reactivity import role_table
from .skew import lookup_join


def blocks_on_library(library: DataFrame, blocks: DataFrame) -> DataFrame:
    """Array rows (name, measure, n) laid over the library by design key.

    Designs without a block have no cells, which is the same as zero in sparse
    form; a block without a design is an error.
    """
    keys = library.select("design_idx", design_key(F.col("header")).alias("name"))
    rows = blocks.join(keys, "name", "left")
    known = F.when(F.col("design_idx").isNull(), F.raise_error(F.concat(F.lit("no design named "), "name"))).otherwise(
        F.col("design_idx")
    )
    return rows.select(known.cast("bigint").alias("design_idx"), "measure", F.posexplode("n").alias("_i", "n")).where(
        "n <> 0"
    ).select("design_idx", (F.col("_i") + 1).alias("pos"), "measure", "n")


def zero_filled(library: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """Every design, with zero where ``values`` (one row per design) has no row."""
    out = library.select("design_idx").join(values, "design_idx", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns})


def structures_for(library: DataFrame, structures: DataFrame) -> DataFrame:
    """Structure of every design by exact sequence; several rows for one sequence are an error.

    Copies of a sequence may dominate the library, so hot sequences are spread.
    """
    one = structures.groupBy("sequence").agg(F.min("structure").alias("structure"), F.count("*").alias("_rows"))
    single = F.when(F.col("_rows") > 1, F.raise_error(F.concat(F.lit("more than one structure for "), "sequence"))).otherwise(
        F.col("structure")
    )
    table = one.select("sequence", single.cast("string").alias("structure"))
    return lookup_join(library.select("design_idx", "sequence"), table, "sequence", spread_by="design_idx")


def tag_matches(tags: DataFrame, conditions: list[Condition]) -> DataFrame:
    """How many tags each condition's names match: (cond_idx, treated, tag, matches)."""
    roles = role_table(tags.sparkSession, conditions)
    found = tags.groupBy("tag").agg(F.count("*").alias("matches"))
    return roles.join(found, "tag", "left").select(
        "cond_idx", "treated", "tag", F.coalesce("matches", F.lit(0)).cast("bigint").alias("matches")
    )


def require_tags(tags: DataFrame, conditions: list[Condition]) -> DataFrame:
    """The condition/tag table; a name that does not match exactly one tag is an error when run."""
    rows = tag_matches(tags, conditions)
    ok = F.when(F.col("matches") != 1, F.raise_error(F.concat(F.lit("tag not matched once: "), "tag"))).otherwise(F.col("tag"))
    return rows.select("cond_idx", "treated", ok.cast("string").alias("tag"))


def to_arrays(long: DataFrame, by: list[str], value: str, size: int | Column) -> DataFrame:
    """Dense arrays per key from sparse (pos, value) rows; groups hold one row per position."""
    packed = long.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("pos", value))).alias("_m"))
    n = F.lit(size) if isinstance(size, int) else size
    cells = F.transform(F.sequence(F.lit(1), n), lambda p: F.coalesce(F.try_element_at("_m", p), F.lit(0)))
    return packed.select(*by, cells.alias(value))


def to_long(arrays: DataFrame, by: list[str], value: str) -> DataFrame:
    """Sparse rows from dense arrays."""
    return arrays.select(*by, F.posexplode(value).alias("_i", value)).where(F.col(value) != 0).select(
        *by, (F.col("_i") + 1).alias("pos"), value
    )


def position_columns(arrays: DataFrame, by: list[str], value: str, size: int, stem: str) -> DataFrame:
    """One column per position, ``<stem>_0001`` on; a projection, not a pivot."""
    return arrays.select(
        *by, *[F.get(F.col(value), F.lit(i - 1)).alias(f"{stem}_{i:04d}") for i in range(1, size + 1)]
    )


def key_columns(rows: DataFrame, by: list[str], key: str, keys: list, value: str) -> DataFrame:
    """One column per listed key value, zero where absent."""
    return rows.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col(key) == k, F.col(value))), F.lit(0)).alias(str(k)) for k in keys
    ])
