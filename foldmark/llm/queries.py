"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from . import alignment, bpe, graph_search, hamming, language, licenses, lm_score, negatives, packing, quantised, repeats, simhash, tokens, urls
from .license_rules import default_rules, phrase_rules

CAPACITY, END_ID, TOKENIZER = 4096, 1, "word_bpe_49k.json"
RANKS, PIECES, JSON = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
HOST_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"), phrase_rules(PHRASES) + default_rules())
    base = F.filter("detections", lambda d: d["protected"])
    labels = lambda ds: F.array_join(F.array_sort(F.array_distinct(F.transform(ds, lambda d: d["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _table(spark, sf_dir, "embeddings").select("vec_id", hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.top_k(codes, codes.where("vec_id % 50 = 0"), 10)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.host_rule(*r) for r in HOST_RULES]
    judged = urls.judge_urls(_table(spark, sf_dir, "pages"), rules + [urls.pattern_rule(p) for p in urls.PATTERNS])
    listed = [r.name for r in rules]
    return judged.select(
        "page_id", "host", "path", F.when(F.col("rule").isin(listed), F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = tokens.tokenized_pieces(docs, public_tokenizers.path(TOKENIZER), CAPACITY, END_ID)
    slim = written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(slim, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    ids = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return ids.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(_table(spark, sf_dir, "documents"), 100)
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm_score.score_documents(docs, language.crc_fold(docs["doc_id"], 5) == 1, public_tokenizers.path(PIECES))


def op9_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def labelled(docs: DataFrame) -> DataFrame:
    """Documents to learn languages from: those outside the held-out third that have a text and a language."""
    return docs.where((language.crc_fold(F.col("doc_id"), 3) != 1) & F.col("text").isNotNull() & F.col("lang").isNotNull())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(labelled(docs)))
    return found.select("doc_id", (language.crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "coverage")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = public_tokenizers.path(JSON), public_tokenizers.path(PIECES)
    found = alignment.aligned(_table(spark, sf_dir, "documents"), first, second, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    slim = written(found.select(*[c for c in found.columns if c != "groups"], digest), "aligned")
    return alignment.align_documents(slim, alignment.vocabulary_size(second), "groups_sha256")


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_exact_topk, op3_url_filter, op4_best_fit_packing, op5_simhash_dedup, op6_byte_bpe, op7_suffix_dedup,
    op8_lattice_lm, op9_graph_ann, op10_language_id, op11_hard_negatives, op12_token_alignment, op13_embedding_dedup,
)}
