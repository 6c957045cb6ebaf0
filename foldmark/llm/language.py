"""Language identification: bit-sliced Bloom filters that answer an n-gram with all languages that have it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import joined_bytes, keyed_texts, text_slices

#: Bytes of an n-gram, bits set for one, slots of the filters (a power of two).
GRAM, HASHES, SLOTS = 4, 3, 1 << 20
#: An n-gram is in a language's filter if it makes at least this share of the language's n-grams there, and at least so
#: much of its largest share in any language. The first bounds a filter to 1 / LEAST_SHARE n-grams, whatever the corpus.
LEAST_SHARE, LEAST_RELATIVE = 2e-5, 0.2
UNKNOWN = "und"

# ASCII letters are lower-cased, other ASCII becomes a blank, bytes of other characters stay.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = np.random.Generator(np.random.PCG64(10)).integers(1 << 40, 1 << 63, HASHES, np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Filters:
    """``slots``: for each slot a bitmask of languages. ``false_rate``: chance that an n-gram a language lacks is found in it."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    common: int


def grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of folded texts (as integers) that hold at most a blank at either end, and each one's text."""
    folded = np.concatenate([_FOLD[data], np.zeros(GRAM, np.uint8)]).astype(np.uint32)
    n = len(data)
    value, inner = np.zeros(n, np.uint32), np.zeros(n, bool)
    for i in range(GRAM):
        value |= folded[i : i + n] << np.uint32(8 * i)
        if 0 < i < GRAM - 1:
            inner |= folded[i : i + n] == 32
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(n)
    at = np.flatnonzero((left >= GRAM) & ~inner)
    return value[at], np.searchsorted(ends, at, side="right") - 1


def slots_of(gram: np.ndarray) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - SLOTS.bit_length() + 1)
    for m in _MULTIPLIERS:
        x = gram.astype(np.uint64) * m
        yield (((x ^ (x >> np.uint64(29))) * m) >> shift).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n), summed within slices, and (lang, null, documents)."""
    for batch in text_slices(batches, most=1 << 20):
        data, ends = joined_bytes(batch.column("text"))
        lang = batch.column("lang").dictionary_encode()
        gram, of = grams(data, ends)
        code = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both, n = np.unique(code[of] << 32 | gram.astype(np.int64), return_counts=True)
        docs = np.bincount(code, minlength=len(lang.dictionary))
        names = np.array(lang.dictionary.to_pylist(), object)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([names[both >> 32], names]), pa.string()),
            pa.array(np.concatenate([both & 0xFFFFFFFF, np.full(len(names), -1)]), pa.int64()),
            pa.array(np.concatenate([n, docs]), pa.int64()),
        ], names=["lang", "gram", "n"])


def fit(labelled: DataFrame) -> Filters:
    """Filters from all rows of (text, lang), both non-null.

    n-grams are counted over whole texts, pre-aggregated in slices and tasks.
    The driver gets one number per language and one mask per filled slot, at
    most SLOTS rows. Up to 63 languages fit a mask; more are an error.
    """
    counts = labelled.select("text", "lang").mapInArrow(_counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    totals = {r[0]: (r[1] or 0, r[2] or 0) for r in counts.groupBy("lang").agg(
        F.sum(F.when(F.col("gram") >= 0, F.col("n"))), F.sum(F.when(F.col("gram") < 0, F.col("n")))).collect()}
    languages = sorted(totals)
    if len(languages) > 63:
        raise ValueError(f"{len(languages)} languages; one mask holds 63")
    if not languages:
        counts.unpersist()
        return Filters([], np.zeros(SLOTS, np.int64), np.zeros(0), 0)
    sizes = F.create_map(*[F.lit(x) for name in languages for x in (name, float(max(1, totals[name][0])))])
    bits = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, 1 << i)])
    shares = counts.where("gram >= 0").withColumn("share", F.col("n") / sizes[F.col("lang")])
    masks = (
        shares.where(F.col("share") >= LEAST_SHARE).groupBy("gram")
        .agg(F.collect_list(F.struct("share", bits[F.col("lang")].alias("bit"))).alias("in"))
        .withColumn("top", F.array_max(F.transform("in", lambda x: x["share"])))
        .select("gram", F.aggregate("in", F.lit(0).cast("bigint"), lambda m, x: F.when(
            x["share"] >= F.col("top") * LEAST_RELATIVE, m.bitwiseOR(x["bit"].cast("bigint"))).otherwise(m)).alias("mask"))
    )

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column("gram").to_numpy(zero_copy_only=False)
            for slot in slots_of(gram):
                yield pa.RecordBatch.from_arrays([pa.array(slot), batch.column("mask")], names=["slot", "mask"])

    filled = masks.mapInArrow(spread, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    counts.unpersist()
    slots = np.zeros(SLOTS, np.int64)
    slots[filled["slot"].to_numpy(np.int64)] = filled["mask"].to_numpy(np.int64)
    small = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * np.dtype(t).itemsize)
    slots = slots.astype(small)
    filling = np.array([np.count_nonzero(slots >> small(i) & small(1)) for i in range(len(languages))]) / SLOTS
    common = max(range(len(languages)), key=lambda i: (totals[languages[i]][1], -i))
    return Filters(languages, slots, filling ** HASHES, common)


def popcounts(filters: Filters, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: its number of n-grams, and for each language how many of them its filter holds."""
    gram, of = grams(data, ends)
    mask = None
    for slot in slots_of(gram):
        mask = filters.slots[slot] if mask is None else mask & filters.slots[slot]
    n = np.bincount(of, minlength=len(ends) - 1)
    kind = filters.slots.dtype.type
    hits = [np.bincount(of[(mask >> kind(i) & kind(1)).astype(bool)], minlength=len(ends) - 1) for i in range(len(filters.languages))]
    return n, np.array(hits).reshape(len(filters.languages), -1).T


PREDICTION = "lang_pred string, score double, n_grams bigint, coverage double"


def predicted(text: Column, filters: Filters, spark: SparkSession) -> Column:
    """A struct of lang_pred, score, n_grams and coverage for each text.

    The popcount of a language is corrected for the false positives expected of
    its filter; the largest share of n-grams decides, of equal ones the first
    language by name; where no filter holds anything, the language of most
    training documents. score is the winner's part of all corrected shares, from
    0 to 1; coverage the winner's own corrected share. ``und`` with score 0
    where the text is null, has no letter, or nothing was learned. The filters,
    of fixed size, go to every executor once.
    """
    shared = spark.sparkContext.broadcast(filters)

    def judge(batch: pa.RecordBatch) -> pa.Array:
        own, size = shared.value, batch.num_rows
        data, ends = joined_bytes(batch.column("text"))
        letters = np.array([bool(_LETTER.search(t)) for t in batch.column("text").to_pylist()], bool)
        names, score, cover = np.full(size, UNKNOWN, object), np.zeros(size), np.zeros(size)
        n = np.zeros(size, np.int64)
        if own.languages:
            n, hits = popcounts(own, data, ends)
            share = np.clip((hits / np.maximum(n, 1)[:, None] - own.false_rate) / (1 - own.false_rate), 0, 1)
            best, whole = share.argmax(axis=1), share.sum(axis=1)
            best[whole == 0] = own.common
            cover = np.where(letters, share[np.arange(size), best], 0)
            score = np.where(letters & (whole > 0), cover / np.where(whole > 0, whole, 1), 0)
            names = np.where(letters, np.array(own.languages, object)[best], UNKNOWN)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score), pa.array(n), pa.array(cover)], names=["lang_pred", "score", "n_grams", "coverage"])

    @F.arrow_udf(PREDICTION)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            batch = pa.RecordBatch.from_arrays([text.fill_null("")], names=["text"])
            parts = [judge(part) for part in text_slices([batch], most=1 << 20)]
            yield pa.concat_arrays(parts) if parts else judge(batch)

    # Nondeterministic for the planner only, lest a filter on the result runs it twice.
    return run.asNondeterministic()(text)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and the fields of ``predicted``.

    Whole texts are read where they are; nothing is shuffled. Null ids and
    repeated rows are kept, other columns ignored.
    """
    found = keyed_texts(docs, id_col, text_col).select("doc_id", predicted(F.col("text"), filters, docs.sparkSession).alias("found"))
    return found.select("doc_id", "found.*")


def crc_fold(id_column: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo the number of folds; a null id is the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % folds
