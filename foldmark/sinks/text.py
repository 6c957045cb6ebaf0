"""Text outputs: FASTA, counts, reads and reactivity entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import to_arrays


def write_fasta(library: DataFrame, path: str, sequence: Column | None = None, blank_line: bool = False) -> None:
    """FASTA part files in library order (a range sort, so writing stays parallel)."""
    seq = F.col("sequence") if sequence is None else sequence
    end = "\n" if blank_line else ""
    library.orderBy("design_idx").select(
        F.concat(F.lit(">"), "header", F.lit("\n"), seq, F.lit(end)).alias("value")
    ).write.text(path)


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")).write.option(
        "compression", compression
    ).text(path)


def counts_lines(counts: DataFrame, library: DataFrame, length: int, sep: str = ",") -> DataFrame:
    """(tag, measure, design_idx, value): one dense line per design, zeros where nothing was counted.

    Every tag and measure present gets a line for every design of the library.
    """
    arrays = to_arrays(counts, ["design_idx", "tag", "measure"], "n", length)
    # at most tags x 16 pairs
    kinds = counts.agg(F.array_sort(F.collect_set(F.struct("tag", "measure"))).alias("k")).scalar()
    grid = library.select("design_idx", F.explode(kinds).alias("k")).select("design_idx", "k.*")
    line = F.array_join(F.transform("n", lambda x: x.cast("string")), sep)
    zeros = F.array_join(F.array_repeat(F.lit("0"), length), sep)
    return grid.join(arrays, ["design_idx", "tag", "measure"], "left").select(
        "tag", "measure", "design_idx", F.coalesce(line, zeros).alias("value")
    )


def write_counts(counts: DataFrame, library: DataFrame, length: int, path: str, sep: str = ",",
                 compression: str = "gzip") -> None:
    """Count matrices under ``tag=/measure=`` folders, lines in library order across part files."""
    lines = counts_lines(counts, library, length, sep)
    ordered = lines.repartitionByRange("tag", "measure", "design_idx").sortWithinPartitions(
        "tag", "measure", "design_idx"
    )
    ordered.select("tag", "measure", "value").write.partitionBy("tag", "measure").option(
        "compression", compression
    ).text(path)
