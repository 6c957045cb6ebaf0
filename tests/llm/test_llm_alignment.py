"""Aligned tokens of two tokenizers against a plain version."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as tokenizers_files
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foldmark.llm import alignment
from foldmark.llm.queries import JSON, PIECES, QUERIES
from pyspark.sql import functions as F

A, B = tokenizers_files.path(JSON), tokenizers_files.path(PIECES)
SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a ▁ b"), (5, " " * 3000), (6, "\n" * 1500 + "x" + "\t" * 1200 + "y"), (7, "x" * 20_000), (8, "日本語 текст ελληνικά é ﬁ ½"),
    (9, "</s> <s> <|endoftext|> <0x41> <unk>"), (10, "\x00\x01 zero"), (None, "no id at all"), (11, "twice the same"), (11, "twice the same"), (12, "​　\x85 odd blanks \xa0"),
    (13, "don't we'll I'm 12345 3.14159 ---- ++++ ...."),
]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = alignment._byte_letters()
    known = {i: bytes(letters[c] for c in t) if t != "<|endoftext|>" else b"?" for t, i in a.get_vocab().items()}
    return a, known, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_alignment(models, texts):
    """Per text (n_a, n_b, n_groups, n_links, groups, n_best, count_sum)."""
    a, known, b = models
    all_groups = []
    for text in texts:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [known[i] for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
                i = j = 0
                for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
                    x, y = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
                    groups.append((ids_a[i:x], ids_b[j:y]))
                    i, j = x, y
        all_groups.append(groups)
    links = [Counter((x, y) for g, h in groups for x in g for y in h) for groups in all_groups]
    counts = Counter(pair for own in links for pair in own)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for groups, own in zip(all_groups, links):
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(n for (x, y), n in own.items() if counts[x, y] == most[x])
        out.append((sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), sum(own.values()),
                    hashlib.sha256(text.encode()).hexdigest() if text else "", best, sum(n * counts[p] for p, n in own.items())))
    return out


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_op12_equals_the_plain_version(spark, models):
    documents = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = [(d, *x) for (d, _), x in zip(documents, plain_alignment(models, [t for _, t in documents]))]
    got = QUERIES["op12_token_alignment"](spark, SF)
    assert key(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect())) == key(want)


def test_odd_texts(spark, models):
    schema = "doc_id bigint, text string, row int, part string, block int, n_a string, groups int, pairs string, pair int, documents int"
    docs = spark.createDataFrame([(d, t, 1, "x", 2, "y", 3, "z", 4, 5) for d, t in ODD], schema)
    found = alignment.written(alignment.aligned(docs, A, B, tokenizers_files.PATTERN), "aligned")
    got = alignment.align_documents(found, alignment.vocabulary_size(B), "groups")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    got = got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "n_best", "count_sum").collect()
    want = [(d, *x) for (d, _), x in zip(ODD, plain_alignment(models, [t for _, t in ODD]))]
    assert key(map(tuple, got)) == key(want)
    assert sum(w[1] == 0 for w in want) >= 3 and sum(w[1] > 0 for w in want) >= 9
    none = alignment.written(alignment.aligned(docs.limit(0), A, B, tokenizers_files.PATTERN), "aligned")
    assert alignment.align_documents(none, alignment.vocabulary_size(B)).collect() == []


def test_pairs_in_bounded_rows_are_all_pairs(models, monkeypatch):
    texts = [t for _, t in ODD if t] + ["the same words again and again " * 40, "x" * 500 + "日本" * 300]
    pair = alignment.Pair(A, B, tokenizers_files.PATTERN)
    whole = {d: dict(zip(k.tolist(), n.tolist())) for _, parts in alignment.Slice(pair, pa.array(texts)).rows() for d, _, k, n in parts}
    for limit in (1, 7, 300):
        monkeypatch.setattr(alignment, "ROW_LINKS", limit)
        cut = {}
        for _, parts in alignment.Slice(pair, pa.array(texts)).rows():
            for d, _, keys, times in parts:
                assert not set(keys.tolist()) & set(cut.get(d, {}))
                cut.setdefault(d, {}).update(zip(keys.tolist(), times.tolist()))
        assert cut == whole


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.sets(st.integers(1, 300), max_size=60), st.sets(st.integers(1, 300), max_size=60), st.integers(301, 310)), max_size=5))
def test_common_ends(documents):
    a, b, a_start, b_start, base = [], [], [0], [0], 0
    for left, right, end in documents:
        a += [base + x for x in sorted(left | {end})]
        b += [base + x for x in sorted(right | {end})]
        a_start.append(len(a))
        b_start.append(len(b))
        base += end
    at_a, at_b = alignment.common_ends(*(np.array(x, np.int64) for x in (a, b, a_start, b_start)))
    want = sorted(set(a) & set(b))
    assert [a[i] for i in at_a] == want and [b[i] for i in at_b] == want
