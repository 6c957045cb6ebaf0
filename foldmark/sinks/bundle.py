"""An analysis on disk: one Parquet table per field, and a metadata record."""

from __future__ import annotations

import json
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..options import Condition
from ..plans.analysis import Analysis
from ..session import fresh_path

TABLES = ("library", "reactivity", "norm_val", "coverage", "reads", "signal_to_noise", "rates")
BY_DESIGN = ("library", "reactivity", "coverage", "reads", "signal_to_noise")


def write_bundle(a: Analysis, path: str, fields: tuple[str, ...] = TABLES) -> None:
    """Write the chosen tables; design tables are ordered within files, so ranges prune."""
    for name in fields:
        df = getattr(a, name)
        if df is None:
            continue
        if name in BY_DESIGN:
            df = df.sortWithinPartitions("design_idx")
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    meta = {
        "version": __version__, "blank5": a.blank5, "blank3": a.blank3, "tags": a.tags,
        "conditions": [asdict(c) for c in a.conditions], "tables": [n for n in fields if getattr(a, n) is not None],
    }
    spark = a.reactivity.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "value string").write.mode("overwrite").text(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def read_table(spark: SparkSession, path: str, name: str, design_range: tuple[int, int | None] | None = None) -> DataFrame:
    """One table; a design range applies to per-design tables only, and has no end where its last is None."""
    df = spark.read.parquet(f"{path}/{name}")
    if design_range is not None and name in BY_DESIGN:
        first, last = design_range
        df = df.where(F.col("design_idx") >= first)
        if last is not None:
            df = df.where(F.col("design_idx") <= last)
    return df


def read_bundle(spark: SparkSession, path: str, design_range: tuple[int, int | None] | None = None) -> Analysis:
    meta = read_metadata(spark, path)
    tables = {n: read_table(spark, path, n, design_range) for n in meta["tables"]}
    for n in TABLES:
        tables.setdefault(n, None)
    return Analysis(
        **tables, conditions=[Condition(**c) for c in meta["conditions"]],
        blank5=meta["blank5"], blank3=meta["blank3"], tags=meta["tags"],
    )


def settle(a: Analysis, fields: tuple[str, ...] = TABLES) -> Analysis:
    """Write tables of an analysis to the shared folder and go on from what was written.

    For what reads a table several times: summaries, and set algebra. Fields
    not named stay lazy plans.
    """
    spark = a.reactivity.sparkSession
    path = fresh_path(spark, "analysis")
    fields = tuple(n for n in fields if getattr(a, n) is not None)
    for name in fields:
        getattr(a, name).write.parquet(f"{path}/{name}")
    return replace(a, **{n: spark.read.parquet(f"{path}/{n}") for n in fields})
