"""Counter blocks, structures, alignments and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import MUT_TYPES
from .lines import blank_ended_blocks, blocks, numbered_lines


def _numbers(csv: str) -> Column:
    return F.transform(F.split(csv, ","), lambda x: F.trim(x).cast("bigint"))


def read_count_blocks(spark: SparkSession, paths) -> DataFrame:
    """(design_idx, name, sequence, m, c) of five-line records: name, sequence, mutations, coverage, blank."""
    rec = blank_ended_blocks(spark, paths, ["name", "sequence", "m", "c"])
    return rec.select(F.col("record").alias("design_idx"), "name", "sequence", _numbers("m").alias("m"), _numbers("c").alias("c"))


def read_raw_count_blocks(spark: SparkSession, paths) -> DataFrame:
    """(name, measure, n array) of 16-line records: name, one line per mutation type, blank.

    The types must come in their fixed order; anything else is an error.
    """
    rec = blocks(numbered_lines(spark, paths), 16, ["name", *MUT_TYPES])
    rows = rec.select("name", F.explode(F.array(*[
        F.struct(F.lit(t).alias("measure"), F.split(F.trim(t), r"\s+").alias("cols")) for t in MUT_TYPES
    ])).alias("x"))
    found = F.col("x.cols")[0]
    return rows.select(
        "name",
        F.when(found != F.col("x.measure"), F.raise_error(F.concat(F.lit("unexpected mutation type "), found)))
        .otherwise(F.col("x.measure")).cast("string").alias("measure"),
        F.transform(F.split(F.col("x.cols")[1], ","), lambda v: v.cast("bigint")).alias("n"),
    )


def read_structures(spark: SparkSession, paths) -> DataFrame:
    """(sequence, structure) of a CSV file with those headings among its columns."""
    return spark.read.option("header", True).csv(paths).select(
        F.translate("sequence", "T", "U").alias("sequence"), "structure"
    )


def read_sam(spark: SparkSession, paths) -> DataFrame:
    """Alignment rows of SAM text; header lines are skipped, dup_count is the dc:i: field."""
    cols = F.split("value", "\t")
    rows = spark.read.text(paths).where(~F.startswith("value", F.lit("@")))
    return rows.select(
        cols[0].alias("read_id"), cols[1].cast("int").alias("flag"), cols[2].alias("ref"),
        cols[3].cast("int").alias("pos"), cols[4].cast("int").alias("mapq"), cols[5].alias("cigar"),
        cols[9].alias("seq"), cols[10].alias("qual"),
        F.coalesce(F.nullif(F.regexp_extract("value", r"dc:i:(\d+)", 1), F.lit("")), F.lit("1"))
        .cast("bigint").alias("dup_count"),
    )


# Where each stage's numbers stand in a run's logs: (order, stage, path, line).
LOG_NUMBERS = (
    (1, "into_merge", r"/0_merge_pairs\.err$", r"Pairs:\s+(\d+)"),
    (2, "merged", r"/0_merge_pairs\.err$", r"Joined:\s+(\d+)"),
    (3, "into_demux", r"/1_[^/]+/[^/]+log$", r"Demultiplexing \S+ (\d+)"),
    (4, "demultiplexed", r"/1_[^/]+/[^/]+log$", r"^(?:\S+\s+){3}(\d+) .*correctly"),
    (5, "into_align", r"/2_[^/]+/[^/]+/bowtie2\.err$", r"^\s*(\d+) reads;"),
    (6, "aligned", r"/2_[^/]+/[^/]+/bowtie2\.err$", r"^\s*(\d+) .*(?:exactly|>1 times)"),
    (7, "aligned_long", r"/2_[^/]+/[^/]+/minimap2\.err$", r"mapped (\d+)"),
    (8, "into_count", r"/3_[^/]+/[^/]+out$", r"covered.* \d+/(\d+)"),
    (9, "counted", r"/3_[^/]+/[^/]+out$", r"covered.* (\d+)/\d+"),
    (10, "into_tensor_count", r"/3_[^/]+/[^/]+log$", r"Total.*reads.*\s([\d,]+)\s*$"),
    (11, "tensor_counted", r"/3_[^/]+/[^/]+log$", r"Mapped.*\s([\d,]+)\s*$"),
)
# Stages whose last log file, by name, is the one that counts.
LAST_LOG_ONLY = ("into_demux", "demultiplexed")


def log_stages(lines: DataFrame, patterns=LOG_NUMBERS) -> DataFrame:
    """(run, stage_no, stage, n_reads) over the log lines (file, value) of each run."""
    def number(pattern: str) -> Column:
        text = F.replace(F.regexp_extract("value", pattern, 1), F.lit(","), F.lit(""))
        return F.nullif(text, F.lit("")).cast("bigint")

    found = F.array(*[
        F.struct(
            F.lit(no).alias("stage_no"), F.lit(stage).alias("stage"),
            F.when(F.col("file").rlike(path), number(line)).alias("n"),
        )
        for no, stage, path, line in patterns
    ])
    rows = lines.select(
        F.regexp_replace("file", r"/[0-9]_.*$", "").alias("run"), "file", F.explode(found).alias("x")
    ).where("x.n IS NOT NULL")
    per_file = rows.groupBy("run", "file", "x.stage_no", "x.stage").agg(F.sum("x.n").alias("n"))
    return per_file.groupBy("run", "stage_no", "stage").agg(
        F.when(F.first("stage").isin(*LAST_LOG_ONLY), F.max_by("n", "file")).otherwise(F.sum("n")).alias("n_reads")
    )


def read_logs(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value) of every log line below a run folder."""
    return spark.read.option("recursiveFileLookup", True).text(folder).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
