"""The registered queries over the smallest tables, against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import plain
import public_tokenizers as tokenizers_files
import pytest
import tiktoken
from tokenizers import Tokenizer

from foldmark.llm import bpe, language, lm_score
from foldmark.llm.oracles import ORACLES
from foldmark.llm.queries import QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    return sorted(rows, key=lambda r: r[0])


def result(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def test_op1(spark, documents):
    got = {r.doc_id: r for r in result(spark, "op1_license_scan")}
    assert len(got) == len(documents)
    for doc, text, _ in documents:
        r = got[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain.base_phrases(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_op4(spark, documents):
    model = Tokenizer.from_file(tokenizers_files.path("word_bpe_49k.json"))
    want = {}
    for doc, text, _ in documents:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        for n, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], "<u4")
            want[doc, n] = (a, len(part), zlib.crc32(part.tobytes()))
    rows = result(spark, "op4_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in bins.values():
        inside.sort()
        assert [o for o, _ in inside] == list(np.cumsum([0] + [n for _, n in inside])[:-1])
        assert sum(n for _, n in inside) <= 4096
    assert len(bins) == -(-sum(n for _, n, _ in want.values()) // 4096)


def test_op5(spark, documents):
    codes = [plain.simhash(t) for _, t, _ in documents]
    ids = [d for d, _, _ in documents]
    want = {d: (f"{c:016x}", k) for d, c, k in zip(ids, codes, plain.classes(ids, codes))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in result(spark, "op5_simhash_dedup")} == want
    assert any(k != d for d, (_, k) in want.items())


def test_op6(spark, documents):
    ranks = bpe.read_ranks(tokenizers_files.path("byte_bpe_multi_50k.tiktoken"))
    model = tiktoken.Encoding("own", pat_str=tokenizers_files.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc, text, _ in documents:
        ids = model.encode_ordinary(text or "")
        want[doc] = (len(ids), plain.digest(ids), hashlib.sha256((text or "").encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in result(spark, "op6_byte_bpe")} == want


def test_op7(spark, documents):
    want = plain.repeats([(d, t) for d, t, _ in documents])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result(spark, "op7_suffix_dedup")}
    assert got == want and any(v[1] for v in want.values())


def test_op8(spark, documents):
    want = plain.base_scores([(d, t) for d, t, _ in documents])
    rows = result(spark, "op8_lattice_lm")
    assert len(rows) == len(want)
    for r in rows:
        held, tokens, known, n, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = lm_score.score_documents(docs, language.crc_fold(docs["doc_id"], 5) == 1, tokenizers_files.path("piece_bpe_32k.model"), rounds=0)
    untrained = sum(r.score for r in first.collect() if r.held_out)
    assert sum(r.score for r in rows if r.held_out) > untrained  # fitting the pieces helps on texts it hasn't seen


def test_op9(spark):
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in result(spark, "op9_graph_ann"):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, found in got.items():
        found.sort()
        product = vectors @ vectors[ids == q][0]
        product[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -product))][:20]
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
        assert [n for n, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(product[ids == v][0], abs=1e-12) for _, v, s in found)
    assert hits / (20 * len(got)) >= 0.9


def test_op10(spark, documents):
    truth = {d: lang for d, _, lang in documents}
    rows = result(spark, "op10_language_id")
    assert {r.doc_id for r in rows} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.95
