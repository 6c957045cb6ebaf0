"""Parts of the operators against brute force, and their defined results for odd inputs."""

import itertools
import math
import random
import re

import numpy as np
import plain
import public_tokenizers as tokenizers_files
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from foldmark.llm import bpe, graph_search, hamming, language, licenses, lm_score, packing, repeats, simhash, tokens, urls
from foldmark.llm.components import components
from foldmark.llm.lattice import Lattice
from foldmark.llm.license_rules import Rule, default_rules, phrase_rules
from foldmark.llm.queries import CAPACITY, TOKENIZER, labelled

RANKS = tokenizers_files.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = tokenizers_files.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "MIT License, the Apache-License! mit license mit license"), (4, "MIT License, the Apache-License! mit license mit license"),
    (None, "a text without an id, in plain english words that go on for a while so that there is something to find in it, and more"),
    (5, "é" * 3000), (6, LONG), (7, "x" * 20_000), (8, "!!! 123 ---"), (9, "one"), (10, "日本語 текст ελληνικά"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long ones, repeated rows, and extra columns named like the operators' own."""
    rows = [(d, t, "en" if d != 9 else None, None, len(t) if t is not None else None, 1, 2, "x", 3, "y", 4) for d, t in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", part int, length int, bucket string, nth int, found string, held_out int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_license_anchor_is_in_every_pattern():
    for rule in default_rules():
        shortest = rule.pattern
        while (bare := re.sub(r"\(\?:[^()]*\)\?|\(\?:([^()|]*)[^()]*\)(?!\?)", r"\1", shortest)) != shortest:
            shortest = bare
        assert rule.anchor in shortest.split(), rule


def test_license_priority_and_containment():
    rules = [Rule("a", "inner", "mit", "mit", 10, 0.5), Rule("b", "outer", "mit", "the mit license", 20, 0.9), Rule("c", "same", "mit", "mit license", 10, 0.6)]
    n, found = licenses.Scanner(rules).scan(b"The MIT-License; mit license")
    assert n == 5 and [(rules[r].label, a, z) for r, a, z in found] == [("outer", 0, 2), ("same", 3, 4)]
    kept = licenses.Scanner(phrase_rules(plain.PHRASES) + rules).scan(b"the mit license")[1]
    assert [a for _, a, _ in kept] == [0, 1]


def test_license_random_texts():
    rng = random.Random(1)
    words = ["MIT", "license", "Apache", "general", "public", "gnu", "the", "x", "ÀÉ", "lesser"]
    scanner = licenses.Scanner(phrase_rules(plain.PHRASES) + default_rules())
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", "-", "\n", ", ", ""]) for _ in range(rng.randrange(40)))
        n, found = scanner.scan(text.encode())
        base = [(scanner.rules[r].label, a) for r, a, _ in found if scanner.rules[r].protected]
        at = [a for _, a in base]
        assert (n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in base}))) == plain.base_phrases(text)


def test_licenses_odd(odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == len(ODD) and {r.doc_id: r.n_words for r in rows}[3] == 0
    assert licenses.scan_licenses(none).collect() == []


def test_hamming_is_exact_with_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(-(1 << 63), 1 << 63, 400)
    codes[50:150] = codes[0]  # a third of all rows
    codes[150:200] = codes[0] ^ 5
    rows = [(int(i), int(c)) for i, c in enumerate(codes)] + [(401, None), (None, 7), (3, int(codes[3]))]
    df = spark.createDataFrame(rows, "vec_id bigint, code bigint")
    got = {}
    for r in hamming.top_k(df, df.where("vec_id % 7 = 0"), 5, shard_rows=100, block_queries=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.vec_id))
    for q in range(0, 400, 7):
        far = sorted((bin((int(codes[q]) ^ int(c)) & (1 << 64) - 1).count("1"), i) for i, c in enumerate(codes) if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, d, i) for n, (d, i) in enumerate(far)]
    assert len(got) == len(range(0, 400, 7))
    assert hamming.top_k(df.limit(0), df.limit(0), 5).collect() == []


def test_sign_code(spark):
    vectors = [[1.0] + [-1.0] * 63, [-1.0] * 63 + [0.5], [float("nan")] + [1.0] * 63, [1.0] * 3, None, [None] + [1.0] * 63]
    df = spark.createDataFrame([(v,) for v in vectors], "v array<double>")
    assert [r.c for r in df.select(hamming.sign_code(df.v).alias("c")).collect()] == [-(1 << 63), 1, None, None, None, None]


def test_urls_odd(spark):
    rules = [urls.host_rule("com", "/", "allow"), urls.host_rule("example.com", "/en/", "block"), urls.host_rule("a.b", "/x", "block"),
             urls.pattern_rule("||ads.^"), urls.pattern_rule("/Casino/".lower()), urls.pattern_rule("*banner*", "block")]
    pages = [(1, "http://WWW.Example.com/en/x?q"), (1, "http://WWW.Example.com/en/x?q"), (2, None), (3, "no scheme"), (4, "s://notexample.com/en/"),
             (5, "s://a.b/xyz"), (6, "s://a.b"), (None, "s://x.org/Casino/1"), (8, "s://q.org/mybanners"), (9, "s://example.com"), (10, "://")]
    df = spark.createDataFrame([(p, u, "h", "r", 1) for p, u in pages], "page_id bigint, url string, host string, rule string, copies int")
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, rules).collect()), key=str)
    assert got == sorted([
        (1, "www.example.com", "/en/x", "example.com/en/", "block")] * 2 + [
        (2, "", "", None, None), (3, "", "", None, None), (4, "notexample.com", "/en/", "com/", "allow"), (5, "a.b", "/xyz", "a.b/x", "block"),
        (6, "a.b", "", None, None), (0, "x.org", "/Casino/1", "/casino/", "block"), (8, "q.org", "/mybanners", "*banner*", "block"),
        (9, "example.com", "", None, None), (10, "", "", None, None)], key=str)
    assert urls.judge_urls(df.limit(0), rules).collect() == [] and len(urls.judge_urls(df, []).collect()) == len(pages)


def test_fullest_bin_is_the_fullest():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        first = max(sizes)
        rest = sorted(sizes)[:-1]
        best = max(first + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k) if first + sum(c) <= 40)
        chosen = packing.fullest({n: sizes.count(n) for n in sizes}, 40)
        assert sum(n * c for n, c in chosen.items()) == best and all(c <= sizes.count(n) for n, c in chosen.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    histogram = {rng.randint(1, 4096): rng.randint(1, 50) for _ in range(300)} | {4096: 10_000, 700: 1_000_000}
    plan = packing.bin_plan(histogram, 4096)
    used = {}
    for times, chosen in plan:
        assert sum(n * c for n, c in chosen.items()) <= 4096
        for n, c in chosen.items():
            used[n] = used.get(n, 0) + n * 0 + c * times
    assert used == histogram and len(plan) <= 2 * len(histogram)
    assert packing.bin_plan({}, 10) == []


def test_packing_odd(spark, odd, none):
    def made(df):
        return packing.pack(tokens.tokenized_pieces(df, tokenizers_files.path(TOKENIZER), CAPACITY, 1), CAPACITY)

    packed = made(odd.coalesce(1))
    whole = packing.sequences(packed).collect()
    rows = packed.collect()
    assert sum(r.length for r in whole) == sum(r.length for r in rows) and all(len(r.ids) == 4 * r.length <= 4 * CAPACITY for r in whole)
    by = {r.sequence_id: bytes(r.ids) for r in whole}
    assert all(by[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) for r in rows)
    assert sorted(r.length for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1] and made(none.coalesce(1)).collect() == []


def test_simhash_links_by_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    codes = {rng.getrandbits(64) for _ in range(30)}
    for c in list(codes):
        for _ in range(12):
            near = c
            for _ in range(rng.randint(1, 4)):
                near ^= 1 << rng.randrange(64)
            codes.add(near)
    centre = rng.getrandbits(64)
    # A large group that shares a half, with links of all kinds.
    codes |= {centre ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) for _ in range(150)}
    codes |= {centre ^ (1 << rng.randrange(64)) for _ in range(40)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    for most in (64, 3):
        monkeypatch.setattr(simhash, "COMPARED", most)
        df = spark.createDataFrame([(c,) for c in signed], "fingerprint bigint")
        pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(df).collect()}
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and a != b for a, b in pairs)
        root = {r.node: r.root for r in components(spark.createDataFrame(list(pairs), "a bigint, b bigint")).collect()}
        assert [root.get(c, c) for c in signed] == plain.classes(signed, codes)


def test_components_of_a_chain_and_none(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {i: 0 for i in range(61)} | {99: 99, 100: 99}
    assert components(chain.limit(0)).collect() == []


def test_simhash_odd(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1} and [r.component_id for r in rows if r.doc_id is None] == [None]
    assert all(r.fingerprint == np.int64(np.uint64(plain.simhash(dict(ODD)[r.doc_id]))) for r in rows)
    assert simhash.near_duplicates(none).collect() == []


def test_bpe_against_the_library():
    encoder = bpe.Encoder(RANKS, tokenizers_files.PATTERN)
    model = tiktoken.Encoding("own", pat_str=tokenizers_files.PATTERN, mergeable_ranks=encoder.merges.ranks, special_tokens={})
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdeéü日 \n'st12") for _ in range(rng.randrange(200))) for _ in range(200)]
    texts += [t for _, t in ODD if t] + ["ab" * 5000, " " * 300, "\u0000\u200b", "'S't're"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode_ordinary(text)
    for word in (b"", b"a", b"hello", "ø".encode() * 40):
        if word:
            assert np.frombuffer(bpe.merge_many([word], encoder.merges)[0], "<u4").tolist() == bpe.merge_one(word, encoder.merges)


def test_bpe_odd(odd, none):
    ids = bpe.encode(odd, RANKS, tokenizers_files.PATTERN)
    rows = ids.select("doc_id", "ids", bpe.decoded(ids["ids"], RANKS).alias("text")).collect()
    assert len(rows) == len(ODD) and all(bytes(r.text).decode() == (dict(ODD)[r.doc_id] or "") for r in rows)
    assert bpe.encode(none, RANKS, tokenizers_files.PATTERN).collect() == []


def test_bucket_pointers():
    rng = np.random.default_rng(7)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[2000:2400] = data[100:500]
    for length in (8, 20, 100):
        pointer = repeats.bucket_pointers(data, length)
        strings = {}
        for i in range(len(data) - length + 1):
            strings.setdefault(data[i : i + length].tobytes(), set()).add(int(pointer[i]))
        assert all(len(p) == 1 for p in strings.values()) and len({next(iter(p)) for p in strings.values()}) == len(strings)


@pytest.mark.parametrize("frequent", [256, 0])
def test_repeats_by_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    monkeypatch.setattr(repeats, "SLICE", 3000)
    rng = random.Random(8)
    line = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [line(n) for n in (99, 100, 101, 150, 400)] + ["x" * 250, "ab" * 90]
    rows = [(i, line(rng.randrange(80)) + rng.choice(shared) + line(rng.randrange(60)) + rng.choice(shared)) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, line(9000) * 2), (301, ""), (302, None)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 100).collect()}
    for doc, want in plain.repeats(rows).items():
        kept = plain.hashlib.sha256(bytes(got[doc].kept)).hexdigest()
        assert (got[doc].n_bytes, got[doc].n_bytes - len(got[doc].kept), len(got[doc].spans), kept) == want


def test_repeats_odd(odd, none):
    rows = repeats.remove_repeats(odd, 100, carry=["part", "bucket"]).collect()
    assert len(rows) == len(ODD) and all(r.carried_0 == 1 and r.carried_1 == "x" for r in rows)
    four = [r for r in rows if r.doc_id == 4]
    assert len(four) == 2 and all(r.spans == [] for r in four)
    assert [len(r.kept) for r in rows if r.doc_id == 7] == [1] and repeats.remove_repeats(none, 100).collect() == []


@pytest.mark.parametrize("frequent", [256, 0])
def test_repeats_without_or_with_shared_ids(spark, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    rng = random.Random(12)
    line = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = line(150)
    # The passage stands at another place in each text; at its place the others have bytes of their own.
    texts = [line(40 * i) + passage + line(400) for i in range(12)]
    rows = [(None, t) for t in texts[:6]] + [(7, t) for t in texts[6:9]] + [(8, t) for t in texts[9:]]
    once = rows + [(None, line(300))] + [(9, line(300))]
    docs = spark.createDataFrame(once + [once[-2]] * 2 + [once[-1]], "doc_id bigint, text string")
    versions = {r.text: r.v for r in docs.selectExpr("text", "xxhash64(text) AS v").collect()}
    ordered = sorted(once + [once[-2]] * 2, key=lambda r: (-1 if r[0] is None else r[0], versions[r[1]]))
    want = plain.repeats(list(enumerate(t for _, t in ordered)))
    want = [(d, *want[i]) for i, (d, _) in enumerate(ordered)]
    want.append(next(w for w in want if w[0] == 9))  # an equal row of the same id is the same document
    got = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), plain.hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in repeats.remove_repeats(docs, 100).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_lattice_sums_over_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", b"bb"]
    log_p = np.log(np.array([0.3, 0.2, 0.15, 0.15, 0.1, 0.1]))
    lattice, at = Lattice(pieces, log_p), {p: i for i, p in enumerate(pieces)}

    def ways(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if word[:n] in at:
                for rest in ways(word[n:]):
                    yield [at[word[:n]], *rest]

    words = [bytes(w) for n in range(1, 8) for w in itertools.product(b"ab", repeat=n)] + [b"ab" * 40]
    expected = np.zeros(len(pieces))
    for word, got in zip(words[:-1], lattice.log_probability(words)):
        each = [(sum(log_p[p] for p in way), way) for way in ways(word)]
        total = math.log(sum(math.exp(x) for x, _ in each))
        assert got == pytest.approx(total)
        for x, way in each:
            np.add.at(expected, way, 3 * math.exp(x - total))
    assert lattice.expected(words[:-1], np.full(len(words) - 1, 3.0)) == pytest.approx(expected)
    long = b"ab" * 40
    forward, _ = lattice._one(long)
    assert forward[-1] == pytest.approx(lattice._forward(lattice._weights(lattice._arcs(np.frombuffer(long, np.uint8)[None, :])), 80)[0, -1])
    assert lattice.expected([long], np.ones(1)) @ np.array(list(map(len, pieces))) == pytest.approx(80)


def test_scores_odd(odd, none):
    def scored(df):
        return lm_score.score_documents(df, language.crc_fold(df["doc_id"], 5) == 1, VOCABULARY)

    rows = scored(odd).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.score < 0 for r in rows)
    assert all(r.n_tokens == len((dict(ODD)[r.doc_id] or "").split()) + 1 for r in rows) and scored(none).collect() == []
    alone = odd.where("doc_id = 4")  # no training documents
    rows = lm_score.score_documents(alone, alone["doc_id"] == 4, VOCABULARY).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2


def test_graph_search_odd(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(300, 8)) * rng.uniform(0.1, 3, (300, 1))
    vectors[100:200] = vectors[5]  # a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [
        (500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [float("inf")] + [1.0] * 7), (504, [1.0] * 3), (None, [1.0] * 8),
        (505, [None] + [1.0] * 7), (3, vectors[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, hits = {}, 0
    for r in graph_search.nearest(df, df.where("vec_id % 20 = 0"), 20, shard_rows=120).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        product = vectors @ vectors[q]
        product[q] = -np.inf
        best = np.lexsort((np.arange(300), -product))[:20]
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
        found.sort()
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found) and len({v for _, v, _ in found}) == 20
        assert all(s == pytest.approx(product[v]) for _, v, s in found)
    assert hits >= 0.9 * 20 * len(got)
    few = df.where("vec_id < 4")
    assert graph_search.nearest(few, few, 20).count() == 12 and graph_search.nearest(df.limit(0), df, 5).collect() == []


def test_language_odd(spark, odd, none):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat and then the dog", "en"), ("der hund und die katze sind hier", "de")] * 20)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = language.fit(train)
    got = {r.doc_id: r for r in language.identify(odd, filters).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {1, 2, 3, 8} and all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(train, filters).where("lang_pred = 'de'").count() == 20
    assert language.identify(none, filters).collect() == []
    nothing = language.fit(labelled(none))
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}


def test_filters_have_no_false_negatives(spark):
    rng = random.Random(10)
    texts = [("".join(rng.choice("abcdefghij ") for _ in range(400)), lang) for lang in ("aa", "bb", "cc") for _ in range(5)]
    filters = language.fit(spark.createDataFrame(texts, "text string, lang string"))
    for text, lang in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        gram, _ = language.grams(data, np.array([0, len(data)]))
        kinds = {}
        for t, other in texts:
            own = np.frombuffer(t.encode(), np.uint8)
            for g in language.grams(own, np.array([0, len(own)]))[0].tolist():
                kinds.setdefault(g, {}).setdefault(other, 0)
                kinds[g][other] += 1
        alone = np.array([len(kinds[g]) == 1 for g in gram.tolist()])
        n, hits = language.popcounts(filters, data, np.array([0, len(data)]))
        assert n[0] == len(gram) and hits[0, filters.languages.index(lang)] >= alone.sum()
        break


def test_pipeline_against_plain_versions(spark, tmp_path):
    rng = random.Random(11)
    english = "the cat sat on the mat and the dog ran to the house while it was raining over there".split()
    german = "der hund und die katze sind hier im haus wenn es draussen regnet und der wind weht".split()
    prose = lambda words, n: " ".join(rng.choice(words) + rng.choice(["", "er", "ly", "s"]) for _ in range(n))
    passage = prose(english, 60)
    rows = [(i, prose(english, 80) + (passage if i % 5 == 0 else ""), "en") for i in range(60)]
    rows += [(100 + i, prose(german, 80), "de") for i in range(30)]
    rows += [(200 + i, rows[3][1], "en") for i in range(4)] + [(300, "123 !!!", "en"), (301, None, "en"), (302, "日本語" * 80, "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    one = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert one.columns == docs.columns
    kept = [r for r in rows if r[0] < 300]
    assert sorted(r.doc_id for r in one.collect()) == [r[0] for r in kept]
    codes = [plain.simhash(t) for _, t, _ in kept]
    kept = [r for r, c in zip(kept, plain.classes([r[0] for r in kept], codes)) if r[0] == c]
    two = corpus_pipeline.STAGES[1][1](spark, one, str(tmp_path))
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == [r[0] for r in kept]
    want = plain.repeats([(d, t) for d, t, _ in kept])
    three = corpus_pipeline.STAGES[2][1](spark, two, str(tmp_path))
    assert three.columns == docs.columns
    for r in three.collect():
        assert (plain.hashlib.sha256(r.text.encode()).hexdigest(), r.n_chars) == (want[r.doc_id][3], len(r.text))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(want)


def test_pipeline_odd(spark, odd, none):
    for df in (odd.select(*[c.split()[0] for c in SCHEMA.split(", ")]), none.select(*[c.split()[0] for c in SCHEMA.split(", ")])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, "")
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == df.columns
            out.collect()


def test_pipeline_keeps_short_texts(spark):
    prose = "the cat sat on the mat and the dog ran to the house while it was raining over there "
    short = [(100, "A.", "en"), (101, "Re.", "en"), (102, "De.", "fr"), (103, "Zyzzyx", "en"), (104, "日本語", None)]
    rows = [(i, prose * 3 + str(i), "en") for i in range(20)] + short
    rows += [(302, "日本語" * 80, "en"), (301, "12 !!", "en"), (300, "", "en"), (303, None, "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], SCHEMA)
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(kept) == {r[0] for r in rows if r[0] < 300} and kept[102] == "fr" and kept[104] is not None


def test_pipeline_keeps_one_of_each_group(spark):
    rng = random.Random(13)
    t, u, v, w, x = (" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(60)) for _ in range(5))
    rows = [(1, t), (5, t), (5, u), (6, v), (6, w), (6, w), (None, t), (None, w), (None, x), (None, x), (None, v.upper()), (9, None), (None, "")]
    docs = spark.createDataFrame([(d, a, "en", "s", i) for i, (d, a) in enumerate(rows)], SCHEMA)
    want = [(1, t), (5, u), (6, v), (6, w), (None, x), (9, None)]
    for part in (docs, docs.orderBy(F.desc("n_chars"))):
        kept = corpus_pipeline.simhash_dedup(spark, part, "")
        assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_signs_that_are_no_letters_have_no_language(spark):
    docs = spark.createDataFrame([(1, "½ ² ³ ① 123"), (2, "the house and the garden"), (3, None)], "doc_id bigint, text string")
    taught = spark.createDataFrame([("the house and the garden are here", "en"), ("das haus und der garten sind hier", "de")], "text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.fit(taught)).collect()}
    assert got[1] == got[3] == ("und", 0.0) and got[2][0] == "en"


def test_search_where_nearly_all_codes_share_a_segment(monkeypatch):
    monkeypatch.setattr(hamming, "MOST_HITS", 5_000)
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 1 << 48, 3_000, np.uint64) << np.uint64(16) | np.uint64(77))
    queries = codes[::100]
    who, at, distance = hamming.search(hamming.Index(codes), np.ones(len(codes), np.int64), queries, 10)
    for q in range(len(queries)):
        all_ = np.bitwise_count(queries[q] ^ codes).astype(np.int64)
        kth = np.sort(all_)[9]
        want = np.flatnonzero(all_ <= kth)
        assert sorted(at[who == q].tolist()) == want.tolist() and (distance[who == q] <= kth).all()


def test_rows_that_repeat_very_often_come_back(spark):
    pages = spark.range(25_001).select(F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("url"))
    pages = pages.union(spark.createDataFrame([(1, "http://a.net/es/x")], "page_id bigint, url string"))
    got = urls.judge_urls(pages, [urls.host_rule("net", "/es/", "block")]).groupBy("page_id", "host", "path", "rule").count().collect()
    assert sorted(map(tuple, got), key=str) == [(1, "a.net", "/es/x", "net/es/", 1), (None, "", "", None, 25_001)]


def test_nearest_of_vectors_of_unequal_lengths(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3_000, 64)) * rng.choice([1, 1, 1, 30, 1e-3], size=(3_000, 1))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in graph_search.nearest(rows, rows.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        product = vectors @ vectors[q]
        product[q] = -np.inf
        hits += len(found & set(np.argsort(-product)[:20].tolist()))
    assert len(got) == 150 and hits >= 0.95 * 20 * 150


def test_pipeline_columns_of_any_name(spark):
    rows = [(i, f"text {i} of the house and the garden where many people live and work together " * (3 if i % 2 else 9), "en", "web", 10, i, i, None, i, i, i) for i in range(12)]
    names = ["doc_id", "text", "lang", "source", "n_chars", "_id", "_found", "_null", "_own_id", "a.b", "row"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 "_id bigint, _found bigint, _null bigint, _own_id bigint, `a.b` bigint, row bigint")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == names
        got = out.collect()
        assert got and all(r["_id"] == r["_found"] == r["_own_id"] == r["a.b"] == r["row"] == r.doc_id and r["_null"] is None for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 12
