"""Hard negatives and embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmark.llm import negatives, quantised

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, slot int, node int, list string, key_1 int, links int, copies int"
EXTRA = ("x", 1, 2, "y", 3, 4, 5)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def plain_negatives(rows, every=10, positives=5, negatives_=10):
    """Rows (id, vector, label) without faults, by sorting all scores of each anchor."""
    out = []
    codes = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    for a in sorted(codes):
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(codes[a], codes[b])), b) for b in codes if b != a)
        near = [(b, -s) for s, b in scores if labels[b] == labels[a]][:positives]
        for p, ps in near:
            fit = [(b, -s) for s, b in scores if labels[b] != labels[a] and 30 * ps <= -100 * s <= 90 * ps][:negatives_]
            out += [(a, p, n, b, ps, s) for n, (b, s) in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("size", [64, 5])
def test_hard_negatives_equal_brute_force(spark, size):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(scale=10.0 ** (i % 3 - 1), size=size).round(2 if i % 2 else 9).tolist(), int(rng.integers(3))) for i in range(300)]
    rows += [(i, rows[i - 300][1], rows[i - 301][2]) for i in range(300, 330)]  # equal vectors: ties
    rows += [(330, [0.0] * size, 1), (340, [0.0] * size, 0)]
    odd = [(400, None, 1), (410, rows[0][1], None), (None, rows[1][1], 1), (420, [float("nan")] * size, 1), (430, [None] + rows[0][1][1:], 1),
           (440, rows[0][1] + [1.0], 2), (450, [], 1), (460, [float("inf")] * size, 0), rows[7], rows[7], rows[10]]
    want = plain_negatives(rows)
    assert len({n for *_, n, _, _ in want}) > 3
    for shard_rows, block in ((1 << 14, 1 << 13), (60, 7)):
        got = negatives.hard_negatives(frame(spark, rows + odd), F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_anchors=block)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hard_negatives_of_an_empty_table_and_of_huge_components(spark):
    none = frame(spark, []).where("false")
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).collect() == []
    rows = [(10, [1e300, 1.0], 1), (11, [1e300, 0.0], 1), (12, [1.0, 40_000.0], 2), (13, [60_000.0, 0.0], 2)]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    most = negatives.LARGEST
    assert [(r.positive_id, r.negative_id, r.positive_score, r.negative_score) for r in got] == [(11, 13, most * most, most * 256 * 60_000)]


def test_bounds_hold_the_score():
    rng = np.random.default_rng(1)
    codes = np.floor(256 * rng.standard_t(2, size=(200, 37))).astype(np.int64)
    side = negatives.Side(codes, *negatives.summaries(codes))
    who, at = (x.ravel() for x in np.meshgrid(range(200), range(200)))
    exact = (codes @ codes.T)[who, at]
    widths = []
    for level in range(len(negatives.SEGMENT_SIZES) + 1):
        low, high = negatives.bounds(side, side, level, who, at)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True) and widths[-1] == 0


def plain_links(ids, vectors, cosine=0.9):
    """{id: (links, smallest id reached)} of sound vectors."""
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    close = units @ units.T >= cosine
    np.fill_diagonal(close, False)
    least = ids.copy()
    while True:
        new = np.minimum(least, np.where(close, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == least).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, close.sum(axis=1), least)}
        least = new


def planted(rng, count, size, copies):
    base = rng.normal(size=(count, size))
    noise = rng.normal(size=(copies, size))
    source = base[rng.integers(count, size=copies)]
    noise -= (noise * source).sum(axis=1)[:, None] * source / (source ** 2).sum(axis=1)[:, None]
    cosine = rng.uniform(0.9, 0.999, size=copies)[:, None]
    near = cosine * source / np.linalg.norm(source, axis=1)[:, None] + np.sqrt(1 - cosine ** 2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    hot = base[0] + 0.1 * rng.normal(size=(copies, size))  # a large group of near copies
    return np.concatenate([base, near * rng.uniform(0.1, 50, size=(copies, 1)), hot, np.repeat(base[1:2], copies, axis=0), base[2:12] * 4])


@pytest.mark.parametrize("size", [64, 10])
def test_embedding_duplicates_equal_brute_force(spark, size):
    vectors = planted(np.random.default_rng(size), 2_000, size, 400).round(6)
    ids = np.random.default_rng(1).permutation(len(vectors)).astype(np.int64) - 50
    want = plain_links(ids, vectors)
    odd = [(90_001, None, 1), (90_002, [0.0] * size, 1), (90_003, [float("nan")] * size, 1), (90_004, [None] * size, 1), (90_005, [1.0], 1), (90_006, [], 1)]
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)]
    got = quantised.near_duplicates(frame(spark, rows + odd + [(None, rows[0][1], 1)])).collect()
    assert len(got) == len(rows) + len(odd) + 1
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert found[None] == (0, None, True) and all(found[i] == (0, i, True) for i, _, _ in odd)
    assert all(found[i][0] <= want[i][0] and found[i][2] == (found[i][1] == i) for i in want)
    assert sum(found[i][0] for i in want) >= 0.98 * sum(n for n, _ in want.values())
    assert np.mean([found[i][1] == c for i, (_, c) in want.items()]) >= 0.98


def test_embedding_duplicates_of_few_rows(spark):
    assert quantised.near_duplicates(frame(spark, []).where("false")).collect() == []
    rows = [(5, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (7, [-1.0, 0.0], 1), (8, [1e300, 1e300], 1), (4, [1e-300, 1e-300], 1), (6, [0.9, 0.4358], 1), (6, [0.9, 0.4358], 1)]
    got = sorted(map(tuple, quantised.near_duplicates(frame(spark, rows)).collect()))
    # (0.9, 0.4358) has a cosine of 0.90001 with (1, 0) and of 0.945 with the diagonal.
    assert got == [(3, 4, 3, True), (4, 3, 3, False), (5, 4, 3, False), (6, 6, 3, False), (6, 6, 3, False), (7, 0, 7, True), (8, 3, 3, False), (9, 4, 3, False)]


def test_lists_split_into_blocks_link_each_pair_once():
    rng = np.random.default_rng(3)
    points = planted(rng, 400, 16, 60)
    units = points / np.linalg.norm(points, axis=1)[:, None]
    q = quantised.Quantiser(units, len(units), float(np.sqrt(0.2)), list_rows=40)
    assert len(q.centres) > 5
    home, probes, codes, error = q.code(units)
    words = np.stack([q.books[m][codes[:, m]] for m in range(codes.shape[1])], axis=1)
    decoded = q.centres[home] + words.reshape(len(units), -1)[:, :16]
    assert np.allclose(np.linalg.norm(units - decoded, axis=1), error)
    for at in range(len(q.centres)):
        own = np.flatnonzero(home == at)
        who, to = q.candidates(units, at, codes[own], error[own])
        near = np.linalg.norm(units[:, None] - units[None, own], axis=2) <= np.sqrt(0.2)
        assert near[who, to].sum() == near.sum()  # no link is lost among what is stored in a probed list
