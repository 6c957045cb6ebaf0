"""Document scores by a subword lattice model whose piece scores are fitted to all training words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .batches import raw_texts, text_slices
from .lattice import WORD_START, Lattice, vocabulary

#: Bytes of text in a block, and behind one bucket of words.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 64 << 20
#: Rounds of expectation and maximization, and what is added to each piece's expected count.
ROUNDS, ADDED = 2, 0.1

_BLOCKS = ("kind int, bucket int, block bigint, docs binary, held binary, sizes binary, tokens binary, words binary, "
           "at binary, counts binary")
_WORDS = "kind int, bucket int, block bigint, words binary, counts binary, at binary, word binary"
_ANSWERS = "block bigint, at binary, counts binary, log_p binary"
_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, count_log10 double, model_log10 double")


def _blocks(buckets: int):
    """Slices of documents as numbers of words (kind 0), and the slice's words by bucket (kind 1).

    A slice asks for each of its different words once, however often and in
    however many of its documents it stands.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        block = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, most=BLOCK_BYTES):
            docs = batch.column("doc_id")
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            split = [t.lower().split() for t in raw_texts(batch.column("text"))]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            coded = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
            words, tokens = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype("<u4")
            counts = np.bincount(tokens[~np.repeat(held, sizes)], minlength=len(words))
            ids = docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            planes = tokens.view(np.uint8).reshape(-1, 4).T.tobytes()
            rows = [(0, 0, block, ids.tobytes(), np.stack([held, docs.is_null().to_numpy(zero_copy_only=False)]).astype("u1").tobytes(),
                     sizes.astype("<i8").tobytes(), press.compress(planes), None, None, None)]
            bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(bucket, kind="stable")
            starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(starts)).tolist():
                own = order[starts[b] : starts[b + 1]]
                rows.append((1, b, block, None, None, None, None, b" ".join(words[i] for i in own.tolist()),
                             own.astype("<u4").tobytes(), counts[own].astype("<i8").tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 7)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                names=["kind", "bucket", "block", "docs", "held", "sizes", "tokens", "words", "at", "counts"],
            )
            block += 1

    return run


def _bucket_words(frame: pd.DataFrame) -> pd.DataFrame:
    """The different words of a bucket with their training counts (kind 0), and which of them each block asks for."""
    asked = [w.split(b" ") for w in frame["words"]]
    coded = pa.array([w for words in asked for w in words], pa.binary()).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary.to_pylist()
    counts = np.bincount(index, np.frombuffer(b"".join(frame["counts"]), "<i8"), len(words)).astype("<i8")
    ends = np.cumsum([0, *map(len, asked)])
    bucket = int(frame["bucket"].iloc[0])
    head = [(0, bucket, 0, b" ".join(words), counts.tobytes(), None, None)]
    return pd.DataFrame(head + [
        (1, bucket, block, None, counts[index[a:z]].tobytes(), at, index[a:z].astype("<u4").tobytes())
        for block, at, a, z in zip(frame["block"], frame["at"], ends[:-1].tolist(), ends[1:].tolist())
    ], columns=["kind", "bucket", "block", "words", "counts", "at", "word"])


def _marked(words: bytes) -> list[bytes]:
    return [WORD_START + w for w in words.split(b" ")]


def _expect(path: str, log_p: np.ndarray | None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, first = vocabulary(path)
        lattice, total = Lattice(pieces, first if log_p is None else log_p), np.zeros(len(pieces))
        for frame in frames:
            for words, counts in zip(frame["words"], frame["counts"]):
                counts = np.frombuffer(counts, "<i8")
                some = np.flatnonzero(counts)
                marked = _marked(words)
                total += lattice.expected([marked[i] for i in some.tolist()], counts[some].astype(float))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"piece": at, "n": total[at]})

    return run


def _answer(path: str, log_p: np.ndarray | None):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        pieces, first = vocabulary(path)
        lattice = Lattice(pieces, first if log_p is None else log_p)
        words = frame[frame["kind"] == 0]["words"].iloc[0]
        scores = lattice.log_probability(_marked(words))
        asked = frame[frame["kind"] == 1]
        return pd.DataFrame({
            "block": asked["block"], "at": asked["at"], "counts": asked["counts"],
            "log_p": [scores[np.frombuffer(w, "<u4")].astype("<f8").tobytes() for w in asked["word"]],
        })

    return run


def _score(known_share: float, total: int, ends: int, end_log_p: float):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        press, out = zstandard.ZstdDecompressor(), []
        at = np.frombuffer(b"".join(answers["at"]), "<u4")
        counts, log_p = np.zeros(len(at) + 1), np.zeros(len(at) + 1)
        counts[at] = np.frombuffer(b"".join(answers["counts"]), "<i8")
        log_p[at] = np.frombuffer(b"".join(answers["log_p"]), "<f8")
        # Log-sum of the whole word as one arc, and of the lattice of pieces.
        def mixed(count, subwords):
            with np.errstate(divide="ignore"):
                return np.logaddexp(np.log(known_share) + np.log(count / max(total, 1)), np.log1p(-known_share) + subwords) / np.log(10)

        model, base = mixed(counts, log_p), np.log10(counts + 0.5)
        for row in blocks.itertuples():
            sizes = np.frombuffer(row.sizes, "<i8")
            held, null = np.frombuffer(row.held, "u1").reshape(2, -1).astype(bool)
            planes = np.frombuffer(press.decompress(row.tokens), np.uint8) if sizes.sum() else np.zeros(0, np.uint8)
            tokens = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
            of = np.repeat(np.arange(len(sizes)), sizes)
            add = lambda x: np.bincount(of, x[tokens], len(sizes))
            out.append(pd.DataFrame({
                "doc_id": pd.array(np.where(null, 0, np.frombuffer(row.docs, "<i8")), "Int64"), "held_out": held, "n_tokens": sizes + 1,
                "n_known": (add((counts > 0).astype(float)) + (ends > 0)).astype(np.int64),
                "count_log10": add(base) + np.log10(ends + 0.5), "model_log10": add(model) + mixed(np.float64(ends), end_log_p),
            }).assign(doc_id=lambda f, null=null: f["doc_id"].mask(null)))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c.split()[0]: [] for c in _SCORES.split(", ")})

    return run


def score_documents(docs: DataFrame, held_out: Column, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """Log10 probabilities of every document under a model of those that aren't held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score. Tokens are the words between ASCII white space, A-Z lower-cased, and
    one end. base_score uses smoothed word counts. In score, a word has a
    lattice of all its segmentations into the vocabulary's pieces, and a word
    known from training is one more arc over it: the arcs of whole words weigh
    1 - (words seen once / tokens), which is the chance that a token is known,
    and the pieces the rest. The pieces' scores are fitted by ``rounds`` of
    expectation and maximization over all training words.

    Words are counted and scored once each, in buckets; blocks of documents ask
    for their different words, so a frequent word costs a row per block. The
    driver sees totals and one number per piece of the vocabulary. Null and
    empty texts are just their end; a null held_out counts as training; null
    ids and repeated rows are kept. Without training documents all words are
    unknown.
    """
    keyed = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size, ends = keyed.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-(size or 0) // BUCKET_BYTES))
    blocks = written(keyed.mapInArrow(_blocks(buckets), _BLOCKS), "blocks")
    asked = blocks.where("kind = 1").select("bucket", "block", "words", "at", "counts")
    words = written(asked.groupBy("bucket").applyInPandas(_bucket_words, _WORDS), "words")
    own = words.where("kind = 0").select("words", "counts")
    n, distinct, once = own.mapInPandas(_totals, "n bigint, words bigint, once bigint").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "words", "once")]).first()
    total, types = n + ends, distinct + (ends > 0)
    known_share = 1 - once / total if total else 0.0
    log_p, end_log_p = None, float(np.log(0.5))
    for _ in range(rounds):
        rows = own.mapInPandas(_expect(vocabulary_path, log_p), "piece int, n double").groupBy("piece").agg(F.sum("n")).collect()
        expected = np.full(len(vocabulary(vocabulary_path)[0]), ADDED)
        expected[[r[0] for r in rows]] += [r[1] for r in rows]
        whole = expected.sum() + ends + ADDED
        log_p, end_log_p = np.log(expected / whole), float(np.log((ends + ADDED) / whole))
    answers = words.groupBy("bucket").applyInPandas(_answer(vocabulary_path, log_p), _ANSWERS)
    documents = blocks.where("kind = 0").select("block", "docs", "held", "sizes", "tokens")
    scored = documents.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(float(known_share), int(total), int(ends), end_log_p), _SCORES)
    below = F.log10(F.lit(float(total)) + 0.5 * (types + 1))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("count_log10") - F.col("n_tokens") * below).alias("base_score"), F.col("model_log10").alias("score"),
    )


def _totals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = [np.frombuffer(c, "<i8") for c in frame["counts"]]
        yield pd.DataFrame({"n": [int(sum(c.sum() for c in counts))], "words": [int(sum((c > 0).sum() for c in counts))],
                            "once": [int(sum((c == 1).sum() for c in counts))]})
