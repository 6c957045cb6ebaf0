"""Count matrices from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MUT_TYPES, MUTS
from .lines import numbered_lines

NAME = r"([^/]+)\.(" + "|".join((MUTS, COVERAGE, *MUT_TYPES)) + r")\.txt(?:\.gz)?$"


def tag_and_measure(file):
    """Tag and measure from a file name, or from the folders of a partitioned write."""
    tag = F.coalesce(F.nullif(F.regexp_extract(file, r"/tag=([^/]+)", 1), F.lit("")), F.regexp_extract(file, NAME, 1))
    measure = F.coalesce(
        F.nullif(F.regexp_extract(file, r"/measure=([^/]+)", 1), F.lit("")), F.regexp_extract(file, NAME, 2)
    )
    return tag, measure


def read_counts_text(spark: SparkSession, paths) -> DataFrame:
    """Sparse counts (design_idx, pos, tag, measure, n) of headerless matrices.

    One line per design, comma or space separated, gzipped or plain. Zeros are
    dropped; empty files contribute nothing.
    """
    lines = numbered_lines(spark, paths)
    tag, measure = tag_and_measure(F.col("file"))
    cells = F.when(F.contains("value", F.lit(",")), F.split("value", ",")).otherwise(F.split(F.trim("value"), " +"))
    long = lines.where(F.trim("value") != "").select(
        F.col("ordinal").alias("design_idx"), tag.alias("tag"), measure.alias("measure"),
        F.posexplode(cells).alias("_i", "_n"),
    )
    return long.select(
        "design_idx", (F.col("_i") + 1).alias("pos"), "tag", "measure", F.trim("_n").cast("bigint").alias("n")
    ).where(F.col("n") != 0)


def read_counts_dir(spark: SparkSession, folder: str, raw_counts: bool = True, partitioned: bool = False,
                    first: int | None = None, last: int | None = None) -> DataFrame:
    """All tags of a counts folder: muts, coverage and, unless told not to, raw counts.

    ``partitioned`` folders are those ``write_counts`` makes; otherwise files
    (or folders of part files) are named <tag>.<measure>.txt[.gz], raw counts
    in their own subfolder.
    """
    if partitioned:
        measures = [MUTS, COVERAGE] + (list(MUT_TYPES) if raw_counts else [])
        paths = f"{folder}/tag=*/measure={{{','.join(measures)}}}"
    else:
        paths = [f"{folder}/*.{{{MUTS},{COVERAGE}}}.txt*"]
        if raw_counts:
            paths.append(f"{folder}/raw_counts/*.txt*")
    counts = read_counts_text(spark, paths)
    return counts if first is None else counts.where(F.col("design_idx").between(first, last))
