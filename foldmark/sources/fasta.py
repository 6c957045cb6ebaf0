"""Sequence libraries and barcodes from FASTA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import numbered_lines


def read_fasta(spark: SparkSession, paths) -> DataFrame:
    """(file, design_idx, header, sequence) in file order, numbered from 1 per file.

    Sequence lines are joined; blank lines and text before the first header
    are ignored. Plain files are split and read in parallel.
    """
    records = numbered_lines(spark, paths, line_sep="\n>", starts_with=">")
    text = F.regexp_replace("value", "^>", "")
    header = F.regexp_replace(F.substring_index(text, "\n", 1), r"\r$", "")
    body = F.when(F.instr(text, "\n") > 0, F.regexp_replace(F.regexp_replace(text, "^[^\n]*\n", ""), r"\s", ""))
    return records.select(
        "file", F.col("ordinal").alias("design_idx"), header.alias("header"),
        F.coalesce(body, F.lit("")).alias("sequence"),
    )


def sequence_info(fasta: DataFrame) -> DataFrame:
    """Library columns from header fields: id, title and author, tab separated.

    Titles and authors are swapped for the whole library when there are fewer
    distinct titles than authors.
    """
    cols = F.split("header", "\t")

    def field(i: int):
        return F.coalesce(F.trim(F.replace(F.get(cols, F.lit(i)), F.lit("%23"), F.lit("#"))), F.lit(""))

    parsed = fasta.select(
        "design_idx",
        F.replace("header", F.lit("%23"), F.lit("#")).alias("header"),
        F.translate("sequence", "T", "U").alias("sequence"),
        cols[0].alias("id_string"),
        F.expr("try_cast(split(header, '\t')[0] AS DOUBLE)").alias("id"),
        field(1).alias("_title"), field(2).alias("_author"),
    )
    # distinct values are counted by grouping, so no task holds them all
    titles = parsed.select("_title").distinct().agg(F.count("*").alias("n")).scalar()
    authors = parsed.select("_author").distinct().agg(F.count("*").alias("n")).scalar()
    swap = titles < authors
    return parsed.select(
        "design_idx", "header", "sequence", "id_string", "id",
        F.when(swap, F.col("_author")).otherwise(F.col("_title")).alias("title"),
        F.when(swap, F.col("_title")).otherwise(F.col("_author")).alias("author"),
    )


def read_barcodes(spark: SparkSession, paths) -> DataFrame:
    """(tag_idx, tag, barcode); a barcode's name may not contain a space."""
    name = F.col("header")
    checked = F.when(F.contains(name, F.lit(" ")), F.raise_error(F.concat(F.lit("space in barcode name: "), name))).otherwise(name)
    return read_fasta(spark, paths).select(
        F.col("design_idx").alias("tag_idx"), checked.cast("string").alias("tag"), F.col("sequence").alias("barcode")
    )
