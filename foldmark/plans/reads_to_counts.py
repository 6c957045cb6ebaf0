"""Read pairs to counts: merge mates, demultiplex, align, call mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import align_pairs, align_reads
from ..operators.pairs import merge_pairs
from ..operators.pileup import pileup
from ..operators.reads import demultiplex, min_mapq, quality_and_adapter_trim
from ..session import written


def reads_to_counts(mates1: DataFrame, mates2: DataFrame | None, library: DataFrame,
                    barcodes: list[tuple[str, str]], max_edits: int | None = None, trim: bool = True, min_quality: int = 10,
                    k: int = 12, max_insert: int = 800, mixed: bool = True) -> DataFrame:
    """Counts of a whole sequencing run.

    ``library`` has design_idx, name and sequence; read 1 starts with the
    barcode and is antisense to the design. Mates that don't overlap are
    placed together (see align_pairs); the second has its tag from the first. Alignments below
    ``min_quality``, as of reads that fit two designs alike, aren't counted.
    Reads are found up to a score limit that grows with their length (see
    align_reads).
    Merged pairs and the aligner's findings are written on the way.
    """
    clean = quality_and_adapter_trim if trim else (lambda reads: reads)
    fields = ["read_id", "tag", "ref", "pos", "mapq", "cigar", "seq", "nm"]
    if mates2 is None:
        aligned = align_reads(demultiplex(clean(mates1), barcodes), library, k=k, strands=("-",)).select(*fields)
    else:
        pairs = written(merge_pairs(mates1, mates2), "merged")
        tagged = demultiplex(clean(pairs.select("read_id", "seq", "qual", "merged")), barcodes)
        aligned = align_reads(tagged.where("merged"), library, k=k, strands=("-",)).select(*fields)
        second = clean(pairs.where("not merged").select("read_id", F.col("mate_seq").alias("seq"), F.col("mate_qual").alias("qual")))
        second = second.select("read_id", F.col("seq").alias("mate_seq"))
        apart = tagged.where("not merged").select("read_id", "tag", "seq").join(second, "read_id", "left")
        aligned = aligned.unionByName(align_pairs(apart, library, max_insert, mixed, k, strands=("-",)).select(*fields))
    if max_edits is not None:
        aligned = aligned.where(F.col("nm") <= max_edits)
    return pileup(min_mapq(aligned, min_quality), library)


def counted_alignments(alignments: DataFrame, library: DataFrame, min_quality: int = 10) -> DataFrame:
    """Counts from ready alignments of any aligner."""
    primary = alignments.where((F.col("flag").bitwiseAND(2304) == 0) & (F.col("mapq") >= min_quality))
    return pileup(primary, library)
