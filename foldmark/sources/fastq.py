"""Reads from FASTQ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import blocks, numbered_lines


def read_fastq(spark: SparkSession, paths) -> DataFrame:
    """(file, record, read_id, seq, qual) of plain or gzipped FASTQ.

    A gzipped file is one input split; gathering the four lines of a record is
    also the shuffle that spreads its reads over the cluster.
    """
    four = blocks(numbered_lines(spark, paths), 4, ["name", "seq", "plus", "qual"])
    return four.where(F.startswith("name", F.lit("@"))).select(
        "file", "record", F.regexp_extract("name", r"^@(\S*)", 1).alias("read_id"), "seq", "qual"
    )


def tag_of_file(file: str = "file"):
    """Tag of a demultiplexed file: its name without the FASTQ suffix."""
    return F.regexp_extract(file, r"([^/]+?)(?:\.fastq|\.fq)?(?:\.gz)?$", 1)
