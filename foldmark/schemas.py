"""Explicit schemas of the tables operators exchange. Positions are 1-based."""

from pyspark.sql import types as T

LIBRARY = T.StructType([
    T.StructField("design_idx", T.LongType(), False),
    T.StructField("header", T.StringType()),
    T.StructField("sequence", T.StringType()),
    T.StructField("id_string", T.StringType()),
    T.StructField("id", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
])

# One row per non-zero count. ``measure`` is a mutation type, "coverage" or "muts".
COUNTS = T.StructType([
    T.StructField("design_idx", T.LongType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("measure", T.StringType(), False),
    T.StructField("n", T.LongType()),
])

# Counts by reference and read nucleotide (tensor layout).
TENSOR_COUNTS = T.StructType([
    T.StructField("design_idx", T.LongType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("ref", T.StringType(), False),
    T.StructField("read", T.StringType(), False),
    T.StructField("n", T.LongType()),
])

READS = T.StructType([
    T.StructField("read_id", T.StringType(), False),
    T.StructField("seq", T.StringType()),
    T.StructField("qual", T.StringType()),
])

ALIGNMENTS = T.StructType([
    T.StructField("read_id", T.StringType(), False),
    T.StructField("flag", T.IntegerType()),
    T.StructField("ref", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("mapq", T.IntegerType()),
    T.StructField("cigar", T.StringType()),
    T.StructField("seq", T.StringType()),
    T.StructField("qual", T.StringType()),
    T.StructField("dup_count", T.LongType()),
])

STRUCTURES = T.StructType([
    T.StructField("sequence", T.StringType(), False),
    T.StructField("structure", T.StringType()),
])
