"""Merging counts as split folders arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import CELL
from ..schemas import COUNTS


def stream_counts(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Counts from Parquet files landing in ``folder``, as a stream."""
    return spark.readStream.schema(COUNTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def merged_stream(counts: DataFrame) -> DataFrame:
    """Element-wise sum of the counts given: of a batch, of several batches' sums, or running, of a stream."""
    return counts.groupBy(*CELL).agg(F.sum("n").alias("n"))


def run_merge(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Sum every file now in ``folder`` and stop; a later run adds what has arrived since.

    The checkpoint knows the files of each batch, so a lost executor or a
    restart does not count a file twice: a batch that runs again replaces the
    folder of its own that holds its sums. No cell is kept between batches, so
    memory and work of a batch follow its files, not all that came before.
    """

    def write(batch: DataFrame, number: int) -> None:
        merged_stream(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream_counts(spark, folder).writeStream
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    """Final counts of ``run_merge``: the sum over all batches."""
    return merged_stream(spark.read.parquet(out))
