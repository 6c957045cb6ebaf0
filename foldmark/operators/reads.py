"""Trimming, filtering, splitting and demultiplexing of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DEMUX_ADAPTER
from ..functions import text as X
from .ordinals import dense_ordinal

SECONDARY_OR_SUPPLEMENTARY = 256 + 2048


def primary_alignments(alignments: DataFrame) -> DataFrame:
    return alignments.where(F.col("flag").bitwiseAND(SECONDARY_OR_SUPPLEMENTARY) == 0)


def min_mapq(alignments: DataFrame, quality: int = 10) -> DataFrame:
    return alignments.where(F.col("mapq") >= quality)


def max_edit_rate(alignments: DataFrame, limit: float) -> DataFrame:
    """Alignments with at most ``limit`` edits (column nm) per read base; no limit when 0."""
    if limit <= 0:
        return alignments
    return alignments.where(F.try_divide(F.col("nm"), F.length("seq")) <= limit)


def exact_length_matches(alignments: DataFrame, template: str, min_count: int) -> DataFrame:
    """Full-length, gapless reads that carry the template's fixed letters and no N."""
    pattern = "^" + template.replace("U", "T").replace("N", "[ACGT]") + "$"
    return alignments.where(
        (F.col("cigar") == f"{len(template)}M") & (F.col("dup_count") >= min_count) & F.col("seq").rlike(pattern)
    )


def quality_trimmed_length(qual: Column, phred: int) -> Column:
    """Length after cutting trailing bases below the threshold (Phred+33)."""
    return F.length(F.regexp_replace(qual, rf"[!-\x{32 + phred:02x}]+$", ""))


def adapter_pattern(adapter: str, min_overlap: int) -> str:
    """The adapter and all behind it, or its longest prefix of at least min_overlap at the read's end."""
    prefixes = [adapter[:k] for k in range(len(adapter) - 1, min_overlap - 1, -1)]
    return f"{adapter}.*$|(?:{'|'.join(prefixes)})$"


def quality_and_adapter_trim(reads: DataFrame, phred: int = 30, adapter: str = DEMUX_ADAPTER,
                             min_overlap: int = 3, min_length: int = 20) -> DataFrame:
    """3' quality trim, then adapter trim; reads left shorter than min_length are dropped."""
    good = F.substring("seq", F.lit(1), quality_trimmed_length(F.col("qual"), phred))
    trimmed = F.regexp_replace(good, adapter_pattern(adapter, min_overlap), "")
    return reads.withColumn("seq", trimmed).withColumn("qual", F.substring("qual", F.lit(1), F.length("seq"))).where(
        F.length("seq") >= min_length
    )


def trim_adapter(reads: DataFrame, three_prime: str | None = None, five_prime: str | None = None) -> DataFrame:
    """Keep reads that have the adapter, trimmed; one of the two ends."""
    if (three_prime is None) == (five_prime is None):
        raise ValueError("give one adapter, 3' or 5'")
    seq = F.col("seq")
    out = X.trim_3prime(seq, three_prime) if three_prime else X.trim_5prime(seq, five_prime)
    keep = [c for c in reads.columns if c not in ("seq", "qual")]
    if "qual" in reads.columns:
        n = F.length("_s")
        qual = F.substring("qual", F.lit(1), n) if three_prime else F.substring("qual", F.length("qual") - n + 1, n)
        return reads.withColumn("_s", out).where("_s IS NOT NULL").select(*keep, F.col("_s").alias("seq"), qual.alias("qual"))
    return reads.withColumn("_s", out).where("_s IS NOT NULL").select(*keep, F.col("_s").alias("seq"))


def clean_long_reads(reads: DataFrame, three_prime: str, five_prime: str) -> DataFrame:
    """Two passes over either strand: each removes the adapter a read has, or drops the read.

    A read is turned when only its reverse complement carries an adapter.
    """
    found = F.filter(F.array("seq", "_rev"), lambda s: s.rlike(f"{three_prime}|{five_prime}"))
    for _ in range(2):
        # one strand with an adapter at most is kept, so each pass is two cheap projections
        picked = reads.withColumn("_rev", X.reverse_complement(F.col("seq"))).withColumn("_s", F.get(found, F.lit(0)))
        cut = F.when(
            F.contains("_s", F.lit(three_prime)), F.substring_index("_s", three_prime, 1)
        ).otherwise(X.trim_5prime(F.col("_s"), five_prime))
        reads = picked.where("_s IS NOT NULL").withColumn("seq", cut).drop("_rev", "_s")
    return reads


def read_chunks(pairs: DataFrame, size: int) -> DataFrame:
    """Number chunks of ``size`` read pairs in the order of ``ordinal``; mates share a row."""
    return dense_ordinal(pairs, "ordinal", "_k").withColumn(
        "chunk", (F.floor((F.col("_k") - 1) / size) + 1).cast("bigint")
    ).drop("_k")


def barcode_neighbourhood(spark: SparkSession, barcodes: list[tuple[str, str]], mismatches: int = 1) -> DataFrame:
    """(prefix, tag): every string within the mismatches of exactly one barcode's best match.

    A string nearest to two barcodes at the same distance belongs to neither.
    The table has at most barcodes * (1 + 4 * length) rows for one mismatch.
    """
    if mismatches not in (0, 1):
        raise ValueError("zero or one mismatch")
    best: dict[str, tuple[int, str | None]] = {}
    for tag, code in barcodes:
        found = {code: 0}
        if mismatches:
            for i, c in enumerate(code):
                found |= {code[:i] + x + code[i + 1:]: 1 for x in "ACGTN" if x != c}
        for text, d in found.items():
            old = best.get(text)
            if old is None or d < old[0]:
                best[text] = (d, tag)
            elif d == old[0]:
                best[text] = (d, None)
    rows = [(t, tag) for t, (_, tag) in best.items() if tag is not None]
    return spark.createDataFrame(rows, "prefix string, tag string")


def demultiplex(reads: DataFrame, barcodes: list[tuple[str, str]], mismatches: int = 1) -> DataFrame:
    """Assign reads by their 5' barcode and cut it off; reads without one are dropped.

    The neighbourhood table is a few dozen strings per barcode the caller
    listed, so the match is a broadcast equi-join on the read's prefix.
    """
    lengths = {len(code) for _, code in barcodes}
    if len(lengths) != 1:
        raise ValueError("barcodes must have one length")
    k = lengths.pop()
    near = F.broadcast(barcode_neighbourhood(reads.sparkSession, barcodes, mismatches))
    rows = reads.withColumn("prefix", F.substring("seq", 1, k)).join(near, "prefix").drop("prefix")
    cut = {"seq": X.excise_start(F.col("seq"), k)}
    if "qual" in reads.columns:
        cut["qual"] = X.excise_start(F.col("qual"), k)
    return rows.withColumns(cut)


def files_by_barcode(files: DataFrame, barcodes: list[tuple[str, str]]) -> DataFrame:
    """(file, tag): demultiplexed files, recognised by a barcode or tag in their name.

    The few barcodes are literals in the expression, so no join takes place.
    """
    codes = F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(c).alias("code")) for t, c in barcodes])
    hit = F.filter(codes, lambda b: (
        ((F.length(b["code"]) > 0) & F.contains(F.col("file"), b["code"])) | F.contains(F.col("file"), b["tag"])
    ))
    return files.select("file", F.explode(hit).alias("b")).select("file", F.col("b.tag").alias("tag"))


def dedup_umi(alignments: DataFrame) -> DataFrame:
    """One alignment per reference, position, strand and UMI: the first read id.

    Groups are combined before the shuffle, so a position most reads share
    costs one row per task.
    """
    strand = F.col("flag").bitwiseAND(16) != 0
    others = [c for c in alignments.columns if c not in ("ref", "pos", "umi")]
    best = alignments.withColumn("strand", strand).groupBy("ref", "pos", "strand", "umi").agg(
        F.min(F.struct("read_id", *[c for c in others if c != "read_id"])).alias("_r")
    )
    return best.select("ref", "pos", "umi", *[F.col(f"_r.{c}").alias(c) for c in others])


def mark_duplicates(alignments: DataFrame) -> DataFrame:
    """Distinct alignments with how often they occurred."""
    return alignments.groupBy("ref", "pos", "cigar", "seq").agg(F.count("*").alias("dup_count"))


def sort_alignments(alignments: DataFrame) -> DataFrame:
    """Coordinate order: ranges of (ref, pos) across partitions, sorted within."""
    return alignments.orderBy("ref", "pos")
