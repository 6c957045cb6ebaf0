"""From raw documents to packed training sequences: four stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm import language, repeats, simhash
from foldmark.llm.queries import labelled, packed_documents
from foldmark.session import written

#: A document whose best language accounts for less than this share of its n-grams has no known language, if it has at
#: least so many n-grams; of fewer (some twenty words) the share says little, and a word of three letters has none.
LEAST_COVERAGE, LEAST_GRAMS = 0.2, 100


def _source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs


def _packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs can clash with a stage's own."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")


def _unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns again, some of them changed."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents written in a language that the labelled ones teach; a null ``lang`` becomes the language found.

    What goes has no letters, or is long enough to judge and has too few n-grams
    of any one language. Languages are learned from the stage's own input. Rows
    pass where they are read.
    """
    docs = _source(spark, docs, sf_dir)
    found = docs.select(_packed(docs), language.predicted(F.col("text"), language.fit(labelled(docs)), spark).alias("found"))
    foreign = (F.col("found.n_grams") >= LEAST_GRAMS) & (F.col("found.coverage") < LEAST_COVERAGE)
    kept = found.where((F.col("found.lang_pred") != language.UNKNOWN) & ~foreign)
    return _unpacked(kept, docs.columns, lang=F.coalesce("row.lang", "found.lang_pred"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the smallest doc_id, one without an id only if none has one.

    Each row belongs to the group of its own text, whatever id it has. Of rows
    with equal id and text one stays. The texts are shuffled once, by id and a
    hash of the text.
    """
    docs = _source(spark, docs, sf_dir)
    names = ["id", "text_1", "text_2"]
    chosen = written(simhash.representatives(docs).toDF(*names, "copies"), "chosen")
    own = dict(zip(["own_id", "own_1", "own_2"], [F.col("doc_id").cast("bigint"), *simhash.text_keys(F.col("text"))]))
    keyed = docs.select(_packed(docs), *[x.alias(name) for name, x in own.items()])
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_1") == F.col("text_1")) & (F.col("own_2") == F.col("text_2"))
    single = keyed.join(chosen.where("copies = 1"), same).select("row")
    # Repeated rows meet as one per task, not all in one place.
    repeated = keyed.join(chosen.where("copies > 1"), same)
    one = repeated.groupBy(*names).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return _unpacked(single.unionByName(one), docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out of every text the strings of 100 bytes that an earlier document, or an earlier place, has too.

    A character of which some bytes go goes whole. A null text stays null, and
    a document of which nothing is left stays as an empty one.
    """
    docs = _source(spark, docs, sf_dir)
    rows = docs.select("doc_id", "text", _packed(docs.drop("text")))
    left = repeats.remove_repeats(rows.withColumn("none", F.col("text").isNull()), 100, carry=["row", "none"], as_text=True)
    left = left.select("spans", F.col("carried_0").alias("row"), F.when(~F.col("carried_1"), F.col("kept")).alias("kept"))
    size = F.when(F.size("spans") > 0, F.length("kept").cast("bigint")).otherwise(F.col("row.n_chars"))
    return _unpacked(left, docs.columns, text=F.col("kept"), n_chars=size)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 tokens."""
    return packed_documents(_source(spark, docs, sf_dir))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("simhash_dedup", simhash_dedup), ("suffix_dedup", suffix_dedup), ("best_fit_packing", best_fit_packing),
]

#: SQL has no word for the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _source(spark, None, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
