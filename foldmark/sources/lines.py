"""Text records with their ordinal, read in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Scan tasks up to which the table of input splits is shipped to every task. A
# task reads at most maxPartitionBytes / openCostInBytes (32 by default) splits.
SHIP_SPLITS_BELOW = 10_000


def logical_file(path: Column) -> Column:
    """A file, or the folder a partitioned write put its part files in."""
    folder = F.regexp_extract(path, r"^(.*)/part-[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(path)


def numbered_lines(spark: SparkSession, paths, line_sep: str | None = None,
                   starts_with: str | None = None, whole: bool = True) -> DataFrame:
    """(file, ordinal, value): records of each logical file numbered 1..n in file order.

    Input splits are numbered independently, and only their record counts (one
    row per split) are brought together to find each split's first ordinal; no
    record is sorted. That table is broadcast behind a check of the number of
    scan tasks; beyond it the join is left to the optimizer, which splits a
    skewed file. With ``starts_with``, a file's first record is dropped
    unless it begins so (text in front of the first real record). Without
    ``whole`` each part file is numbered by itself.
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    raw = reader.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # The file's name is found once per split: doing so for each line took more time than reading it.
    counted = raw.groupBy("_path", "_block").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_k"),
        F.min_by(~F.startswith("value", F.lit(starts_with or "")), "_id").alias("_odd"),
    )
    preamble = (F.col("_block") == 0) & F.col("_odd") if starts_with else F.lit(False)
    file = logical_file(F.col("_path")) if whole else F.col("_path")
    counted = counted.withColumn("_skip", preamble.cast("int")).withColumn("file", file)
    before = Window.partitionBy("file").orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.select(
        "file", "_path", "_block", "_first", "_skip",
        F.coalesce(F.sum(F.col("_k") - F.col("_skip")).over(before), F.lit(0)).alias("_offset"),
    )
    # Joined by key, all lines of an unsplittable file would go to one task.
    if raw.rdd.getNumPartitions() < SHIP_SPLITS_BELOW:
        splits = F.broadcast(splits)
    place = F.col("_id") - F.col("_first") - F.col("_skip") + 1
    return (
        raw.join(splits, ["_path", "_block"]).where(place > 0)
        .select("file", (F.col("_offset") + place).cast("bigint").alias("ordinal"), "value")
    )


def blocks(lines: DataFrame, size: int, names: list[str]) -> DataFrame:
    """Gather every ``size`` lines into one row; ``names`` label the first lines, in order."""
    k = F.pmod(F.col("ordinal") - 1, F.lit(size))
    record = F.floor((F.col("ordinal") - 1) / size).cast("bigint") + 1
    return lines.select("file", record.alias("record"), k.alias("_k"), "value").where(F.col("_k") < len(names)).groupBy(
        "file", "record"
    ).agg(*[F.max(F.when(F.col("_k") == i, F.col("value"))).alias(n) for i, n in enumerate(names)])


def _regular(spark: SparkSession, paths, size: int) -> bool:
    """Whether in every part file each ``size``-th line is blank and no other is, the last line is one of them, and no line ends in a return."""
    lines = numbered_lines(spark, paths, "\n", whole=False)
    odd = (F.col("value") == "") != (F.col("ordinal") % size == 0)
    each = lines.groupBy("file").agg(F.max("ordinal").alias("_n"), F.max(odd | F.contains("value", F.lit("\r"))).alias("_odd"))
    return each.where(F.col("_odd") | (F.col("_n") % size != 0)).isEmpty()


def blank_ended_blocks(spark: SparkSession, paths, names: list[str]) -> DataFrame:
    """(file, record, names...): records of a line for each name and a blank one.

    Where blank lines stand nowhere else, records are read whole by them, and
    no line is shuffled; other files are gathered line by line.
    """
    size = len(names) + 1
    if not _regular(spark, paths, size):
        return blocks(numbered_lines(spark, paths), size, names)
    cells = F.split("value", "\n")
    return numbered_lines(spark, paths, "\n\n").select(
        "file", F.col("ordinal").alias("record"), *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])
