"""Hand-computed cases on a few designs."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldmark import session
from foldmark.functions import text as X
from foldmark.operators import joins as J
from foldmark.operators import merge as M
from foldmark.operators import normalize as N
from foldmark.operators import ordinals as O
from foldmark.operators import reactivity as R
from foldmark.operators import reads as D
from foldmark.operators import spread as S
from foldmark.operators import stats as Q
from foldmark.operators import subdivide as B
from foldmark.operators import validate as K
from foldmark.operators.signal import classify_signal, signal_to_noise
from foldmark.operators.skew import lookup_join
from foldmark.options import ReactivityOptions, conditions_for
from foldmark.plans import analysis as A
from foldmark.queries import all_queries
from foldmark.queries import views as V
from foldmark.schemas import COUNTS
from foldmark.streaming import merge as T


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def counts_df(spark, data):
    return spark.createDataFrame(data, "design_idx bigint, pos int, tag string, measure string, n bigint")


# Ordinals, ranks, skew ------------------------------------------------------------------------------

def test_dense_ordinal_crosses_ranges(spark):
    keys = [3, 4, 70, 71, 72, 500, 501, 9000]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    assert rows(O.dense_ordinal(df, "k", "o", bucket=50), "k") == [(k, i + 1) for i, k in enumerate(keys)]


def nearest_rank(values):
    v = sorted(values)
    return v[(9 * len(v) + 5) // 10 - 1]


@pytest.mark.parametrize("n", [1, 5, 6, 15, 16, 25, 1000, 2001])
def test_nearest_rank_rounds_halves_up(spark, n):
    assert (9 * n + 5) // 10 == math.floor(0.9 * n + 0.5)
    rng = random.Random(n)
    values = [rng.choice([0.0, rng.random(), 0.25]) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "g string, v double")
    want = nearest_rank(values)
    if want == 0:
        rest = [v for v in values if v != 0]
        want = nearest_rank(rest) if rest else 0.0
    for f in (O.nearest_rank,):
        assert rows(f(df, ["g"], "v", "x")) == [("g", want)]


def test_nearest_rank_zero_rule(spark):
    df = spark.createDataFrame([("a", 0.0)] * 30 + [("a", 2.0), ("a", 5.0)] + [("b", 0.0)] * 4, "g string, v double")
    for f in (O.nearest_rank,):
        assert rows(f(df, ["g"], "v", "x"), "g") == [("a", 5.0), ("b", 0.0)]


def test_large_rank_with_one_dominant_value(spark):
    values = [1.0] * 4000 + [i / 1000 for i in range(3000)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    assert rows(O.nearest_rank(df, ["g"], "v", "x")) == [("g", nearest_rank(values))]
    middle = sorted(values)
    assert rows(O.median(df, ["g"], "v", "x")) == [("g", (middle[3499] + middle[3500]) / 2)]


@pytest.mark.parametrize("find_hot", [True, False])
def test_lookup_join_matches_plain_join(spark, find_hot):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"))
    right = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        want = sorted(rows(left.join(right, "k", how)), key=str)
        assert sorted(rows(lookup_join(left, right, "k", "id", how, find_hot=find_hot)), key=str) == want


# Validation -----------------------------------------------------------------------------------------

def test_duplicates_ignore_blanks(spark):
    seqs = ["AC", "", "GG", "AC", "", "AC", "GG"]
    lib = spark.createDataFrame([(i + 1, s) for i, s in enumerate(seqs)], "design_idx bigint, sequence string")
    assert rows(K.repeated_values(lib), "design_idx") == [(4, 3, "AC"), (6, 4, "AC"), (7, 5, "GG")]


def test_alphabet_is_upper_case(spark):
    lib = spark.createDataFrame([(1, "ACGTUN"), (2, "acgu"), (3, "ACX"), (4, "")], "design_idx bigint, sequence string")
    assert rows(K.check_alphabet(lib), "design_idx") == [(1, True), (2, False), (3, False), (4, True)]


# Reactivity -----------------------------------------------------------------------------------------

def test_background_subtraction_by_hand(spark):
    c = counts_df(spark, [
        (1, 1, "T", "coverage", 100), (1, 1, "T", "AC", 4), (1, 1, "T", "del", 1), (1, 1, "T", "ins", 50),
        (1, 1, "N", "coverage", 50), (1, 1, "N", "AG", 1),
        (1, 2, "T", "coverage", 10),
        (2, 1, "N", "coverage", 9),
    ])
    out = rows(R.subtract_background(c, conditions_for([("T", "N")])).select(
        "design_idx", "pos", "strict", "strict_err", "del", "del_err", "floor_err"), "design_idx", "pos")
    assert len(out) == 2
    assert out[0][2:] == pytest.approx((0.04 - 0.02, math.sqrt(4 / 1e4 + 1 / 2500), 0.01, 0.01,
                                        math.sqrt(1e-4 + 1 / 2500)))
    assert out[1][2:] == (None,) * 5  # no control coverage there


def test_signal_needs_more_than_three_points(spark):
    data = [(1, p, 1, float(p), 1.0, 4) for p in (1, 2, 3, 4)] + [(2, p, 1, float(p), 1.0, 3) for p in (1, 2, 3)]
    data += [(3, p, 1, None if p == 2 else float(p), 0.0 if p == 1 else 2.0, 7) for p in range(1, 8)]
    r = spark.createDataFrame(data, "design_idx bigint, pos int, cond_idx int, r double, r_err double, seq_len int")
    # third design: good points 3..7, of which 4, 5, 6 remain
    assert rows(signal_to_noise(r, None, 0, 0), "design_idx") == [(1, 1, 2.5), (2, 1, 0.0), (3, 1, 2.5)]


def test_signal_classes(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (1.0,), (5.0,), (10.0,)], "s double")
    got = [r[0] for r in df.select(classify_signal(F.col("s"))).collect()]
    assert got == ["N/A", "weak", "N/A", "medium", "good", "strong"]


def brute_spread(seq, strict, se, dele, de):
    """Every run of one letter shares out what its last position has, in proportion to the positive strict rates."""
    out, err = [], []
    for _, run in itertools.groupby(range(len(seq)), key=lambda i: seq[i]):
        run = list(run)
        weight = np.clip([strict[i] for i in run], 0, None)
        share = weight / weight.sum() if weight.sum() > 0 else np.full(len(run), 1 / len(run))
        share_err = np.array([se[i] for i in run]) * (1 - share) / weight.sum() if weight.sum() > 0 else np.zeros(len(run))
        own, own_err = np.array([dele[i] for i in run]), np.array([de[i] for i in run])
        given, given_err = own[-1], own_err[-1]
        own[-1] = own_err[-1] = 0
        out += (own + given * share).tolist()
        err += np.sqrt(own_err ** 2 + (given_err * share) ** 2 + (given * share_err) ** 2).tolist()
    return out, err


def test_spread_against_brute_force_and_conserves_mass(spark):
    rng = random.Random(3)
    lib, prof, want = [], [], {}
    for d in range(1, 30):
        seq = "".join(rng.choice("ACGU") * rng.randint(1, 4) for _ in range(rng.randint(1, 9)))
        cols = [[rng.choice([0.0, -0.1, 0.2, rng.random()]) for _ in seq] for _ in range(4)]
        lib.append((d, seq))
        prof += [(d, p + 1, 1, *(c[p] for c in cols)) for p in range(len(seq))]
        want[d] = brute_spread(seq, *cols)
    library = spark.createDataFrame(lib, "design_idx bigint, sequence string")
    profiles = spark.createDataFrame(
        prof, "design_idx bigint, pos int, cond_idx int, strict double, strict_err double, del double, del_err double")
    got = rows(S.spread_deletions(S.on_library(profiles, library, [1])).select("design_idx", "pos", "del", "del_err"))
    assert len(got) == len(prof)
    for d, p, x, e in got:
        assert x == pytest.approx(want[d][0][p - 1], abs=1e-12)
        assert e == pytest.approx(want[d][1][p - 1], abs=1e-12)
    for d, seq in lib:
        assert sum(x for i, _, x, _ in got if i == d) == pytest.approx(sum(r[5] for r in prof if r[0] == d))


def test_tracks_add_up_to_reactivity(spark):
    rng = random.Random(5)
    data = []
    for d in (1, 2):
        for p in range(1, 7):
            for t in "TN":
                data.append((d, p, t, "coverage", 200))
                data += [(d, p, t, m, rng.randint(1, 9)) for m in ("AC", "GA", "TG", "CT", "del", "ins") if rng.random() < 0.7]
    lib = spark.createDataFrame([(1, "AAGGCU"), (2, "ACCCCU")], "design_idx bigint, sequence string")
    out = A.reactivity(counts_df(spark, data), lib, conditions_for([("T", "N")]), ReactivityOptions(separate_tracks=True))
    for r in out.collect():
        assert r.to_A + r.to_C + r.to_G + r.to_T + r["del"] == pytest.approx(r.r)


def test_option_precedence():
    both = ReactivityOptions(no_GA=True, only_GA=True, only_AG=True)
    assert "GA" not in both.mismatches and both.counts_deletions and both.only_base is None
    assert ReactivityOptions(only_GA=True, only_AG=True).mismatches == ("GA",)
    assert ReactivityOptions(only_AG=True).only_base == "A"


def test_conditions_default_to_every_tag():
    assert [(c.cond_idx, c.treated, c.control) for c in conditions_for([], ["x", "y"])] == [(1, "x", None), (2, "y", None)]


# Normalization --------------------------------------------------------------------------------------

@pytest.mark.parametrize("high,mid,low,want", [
    (10, 0, 5, 10000), (9, 1, 5, 1000), (9, 0, 1, 100), (4, 3, 2, -1),
])
def test_cascade(spark, high, mid, low, want):
    values = [20000] * high + [2000] * mid + [200] * low + [5] * 20
    totals = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "design_idx bigint, total_coverage bigint")
    assert N.coverage_cutoff(totals).first()[0] == want


@pytest.mark.parametrize("n,kept", [(1000, 1000), (1001, 1001), (1999, 1999), (2000, 1000), (3001, 1000)])
def test_stride(spark, n, kept):
    totals = spark.range(1, n + 1).select(F.col("id").alias("design_idx"), F.lit(20000).cast("bigint").alias("total_coverage"))
    assert N.normalization_set(totals).count() == n
    got = [r[0] for r in N.normalization_set(totals, 1000).orderBy("design_idx").collect()]
    stride = n // 1000 if n > 1000 else 1
    assert got == list(range(stride, n + 1, stride)) and len(got) == kept


def test_ranks_of_a_large_group(spark):
    df = spark.range(400_000).select(F.lit("a").alias("g"), ((F.col("id") * 7919) % 400_009).cast("double").alias("v"))
    values = sorted(float(i * 7919 % 400_009) for i in range(400_000))
    assert rows(O.nearest_rank(df, ["g"], "v", "x")) == [("a", values[360_000 - 1])]
    assert rows(O.median(df, ["g"], "v", "x")) == [("a", (values[199_999] + values[200_000]) / 2)]


def test_blanking_follows_each_length(spark):
    r = spark.createDataFrame([(d, p, n, 1.0) for d, n in ((1, 4), (2, 6)) for p in range(1, n + 1)],
                              "design_idx bigint, pos int, seq_len int, r double")
    kept = rows(N.blank_ends(r, 1, 2, ["r"]).where("r IS NOT NULL").select("design_idx", "pos"), "design_idx", "pos")
    assert kept == [(1, 2), (2, 2), (2, 3), (2, 4)]


# Merging, tags, sub-libraries -----------------------------------------------------------------------

def test_split_and_merge_is_invariant(spark):
    rng = random.Random(1)
    data = [(rng.randint(1, 5), rng.randint(1, 4), rng.choice("AB"), "GA", rng.randint(1, 9)) for _ in range(400)]
    whole = sorted(rows(M.merge_counts(counts_df(spark, data))))
    parts = [counts_df(spark, data[i::3]) for i in range(3)]
    assert sorted(rows(M.merge_counts(*parts))) == whole


def test_stream_merge_keeps_no_cells_between_batches(spark, tmp_path):
    rng = random.Random(2)
    data = [(rng.randint(1, 5), rng.randint(1, 4), rng.choice("AB"), "GA", rng.choice([1, 2, 3, None])) for _ in range(400)]
    landing, out, checkpoint = (f"{tmp_path}/{x}" for x in ("landing", "out", "checkpoint"))
    for i in range(3):
        spark.createDataFrame(counts_df(spark, data[i::3]).rdd, COUNTS).write.mode("append").parquet(landing)
        T.run_merge(spark, landing, out, checkpoint).awaitTermination()
    T.run_merge(spark, landing, out, checkpoint).awaitTermination()  # nothing new, nothing counted twice
    assert sorted(rows(T.latest_totals(spark, out))) == sorted(rows(M.merge_counts(counts_df(spark, data))))
    assert not (tmp_path / "checkpoint" / "state").exists()


def test_tag_must_match_once(spark):
    tags = spark.createDataFrame([("a",), ("b",), ("b",)], "tag string")
    ok = J.require_tags(tags, conditions_for([("a",)]))
    assert rows(ok) == [(1, True, "a")]
    for pair in (("b",), ("missing",)):
        with pytest.raises(PySparkException):
            J.require_tags(tags, conditions_for([pair])).collect()


def test_structures_must_be_single(spark):
    lib = spark.createDataFrame([(1, "AC"), (2, "AC"), (3, "GG")], "design_idx bigint, sequence string")
    one = spark.createDataFrame([("AC", "..")], "sequence string, structure string")
    assert sorted(rows(J.structures_for(lib, one).select("design_idx", "structure"))) == [(1, ".."), (2, ".."), (3, None)]
    with pytest.raises(PySparkException):
        J.structures_for(lib, one.union(one)).collect()


def test_sublibrary_tag(spark):
    h = [("7\tx\tsublibrary:one, more",), ("sublibrary:two\tz",), ("plain",)]
    df = spark.createDataFrame(h, "header string")
    assert [r[0] for r in df.select(B.sublibrary(F.col("header"))).collect()] == ["one", "two", "unassigned"]


# Reads ----------------------------------------------------------------------------------------------

def test_demultiplex_mismatches_and_ties(spark):
    codes = [("X", "AAAA"), ("Y", "AATT"), ("Z", "GGGG")]
    reads = ["AAAACC", "AAACCC", "AATACC", "GGGGTT", "GGGATT", "GGAATT", "TTTTTT"]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(reads)], "read_id string, seq string")
    got = {r.read_id: (r.tag, r.seq) for r in D.demultiplex(df, codes).collect()}
    # AATA is one mismatch from both X and Y: unassigned; GGAA has two mismatches
    assert got == {"0": ("X", "CC"), "1": ("X", "CC"), "3": ("Z", "TT"), "4": ("Z", "TT")}


def test_padding_and_revcomp(spark):
    df = spark.createDataFrame([([1, 2],)], "a array<bigint>")
    assert df.select(X.pad_zeros(F.col("a"), F.lit(4))).first()[0] == [1, 2, 0, 0]
    s = spark.createDataFrame([("AACGU",)], "s string")
    assert s.select(X.reverse_complement(F.col("s"))).first()[0] == "ACGTT"


def test_dense_ordinal_of_sparse_keys_runs_no_window(spark):
    keys = sorted({(i * 0x9E3779B97F4A7C15 + 11) % (1 << 63) - (1 << 62) for i in range(20_000)})
    df = spark.createDataFrame([(k, "x" * (k % 3)) for k in keys], "k bigint, x string").repartition(5)
    out = O.dense_ordinal(df, "k", "o")
    assert [tuple(r) for r in out.select("k", "o").orderBy("k").collect()] == [(k, i + 1) for i, k in enumerate(keys)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert O.dense_ordinal(df.limit(0), "k", "o").count() == 0


def test_stride_over_sparse_designs(spark):
    totals = spark.createDataFrame([(i * 10**12 + 5, 20_000 if i % 3 else 7) for i in range(90)], "design_idx bigint, total_coverage bigint")
    passing = [i * 10**12 + 5 for i in range(90) if i % 3]
    assert [r[0] for r in N.normalization_set(totals, 20).orderBy("design_idx").collect()] == passing[2::3]
    assert N.normalization_set(totals, 60).count() == 60


def test_signal_of_nothing_inside_is_zero(spark):
    """Ends that are much larger than what they enclose leave no rounding error behind."""
    r = spark.createDataFrame(
        [(1, p, 1, v, 0.1) for p, v in enumerate((0.7, 0.1, -0.1, 0.0, 0.3), 1)]
        + [(2, p, 1, v, e) for p, (v, e) in enumerate(((0.7, 0.9), (0.3, 0.3), (0.1, 0.1), (0.2, 0.2), (0.6, 0.7)), 1)],
        "design_idx int, pos int, cond_idx int, r double, r_err double").withColumn("seq_len", F.lit(5))
    assert rows(signal_to_noise(r, None, 0, 0), "design_idx") == [(1, 1, 0.0), (2, 1, 1.0)]


def test_human_readable_rounds_the_double_itself(spark):
    xs = [0, 1, 999, 1000, 871_250, 871_350, 846_550, 912_250, 1_950, 1_050, 999_949, 999_950, 999_999, 12_345_678, 10**12 + 5 * 10**10]
    for sign in (1, -1):
        df = spark.createDataFrame([(sign * x,) for x in xs], "x bigint")
        got = [t for _, t in rows(df.select("x", Q.human_readable(F.col("x"))))]
        power = lambda x: sum(x >= 1000 ** k for k in range(1, 5))
        assert got == ["0" if x == 0 else f"{x / 1000 ** power(x):.1f}{Q.UNITS[power(x)]}" for x in (sign * x for x in xs)]


def test_grid_is_dealt_out_before_it_grows(spark):
    """A library read by one task is expanded by many, none with more than its share."""
    library = spark.range(1, 401).select(F.col("id").cast("int").alias("design_idx"), F.lit("ACGUACGU").alias("sequence")).coalesce(1)
    grid = S.condition_grid(library, [1, 2])
    sizes = [n for _, n in grid.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert sum(sizes) == 400 * 8 * 2 and len(sizes) == 4 and max(sizes) < 400 * 8 * 2 // 2


def test_ranks_do_not_depend_on_where_a_second_sketch_cuts(spark, monkeypatch):
    import os

    real = F.percentile_approx
    moved = F.udf(lambda cuts: [c + int.from_bytes(os.urandom(2)) / 3000 for c in cuts], "array<double>").asNondeterministic()
    monkeypatch.setattr(O.F, "percentile_approx", lambda *a: moved(real(*a)))
    df = spark.range(4000, numPartitions=7).select((F.col("id") % 2).alias("g"), (F.col("id") * 0.25).alias("v"))
    values = {g: [i * 0.25 for i in range(g, 4000, 2)] for g in (0, 1)}
    for _ in range(3):
        assert sorted(rows(O.nearest_rank(df, ["g"], "v", "x"))) == [(g, nearest_rank(values[g])) for g in (0, 1)]


def test_rounding_is_that_of_the_sql(spark):
    import duckdb

    values = [k + 0.5 for k in range(3)] + [(2 * k + 1) / 2**11 + 7 for k in range(40)]
    values += [math.nextafter((k + 0.5) / 1e9, s) for k in range(1_900_000_000, 1_900_003_000) for s in (0.0, 9.0)]
    got = V.rounded(spark.createDataFrame([(i, v, -v) for i, v in enumerate(values)], "i int, v double, m double"), "v", "m").orderBy("i").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v DOUBLE)")
    con.execute(f"INSERT INTO t VALUES {', '.join(f'({v!r}::DOUBLE)' for v in values)}")
    want = con.execute("SELECT round(v, 9), round(-v, 9) FROM t ORDER BY rowid").fetchall()
    assert [(r.v, r.m) for r in got] == want


def test_tasks_follow_the_rows_not_the_session_alone(spark, monkeypatch):
    """What one task holds stays the same when the input grows and the session's partitions don't (here 4)."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    library = spark.range(1, 401).select(F.col("id").cast("int").alias("design_idx"), F.lit("ACGUACGU").alias("sequence"))
    counts = library.select("design_idx", F.lit(3).alias("pos"), F.lit("T").alias("tag"), F.lit("coverage").alias("measure"),
                            F.lit(9).cast("bigint").alias("n"))
    items = V.table(spark, "/root/testdata/sf0.001", "lineitem").count()
    for df, most in ((S.condition_grid(library, [1, 2]), 6400), (V.counts(spark, "/root/testdata/sf0.001"), 2 * items),
                     (A.reactivity(counts, library, conditions_for([("T",)] * 2)), 6400)):
        sizes = [n for _, n in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        assert len(sizes) == -(-most // 500) and max(sizes) < 2 * 500


def test_paired_counts_follow_the_line_items(spark, monkeypatch):
    """Without a grid too, the tasks that pair treated and control counts grow with the items, not the session's 4."""
    sf = "/root/testdata/sf0.001"
    tasks = -(-2 * V.table(spark, sf, "lineitem").count() // 500)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    for name in ("p05_background_subtraction", "j01_join_treated_control", "p06_legacy_reactivity", "a10_signal_to_noise"):
        sizes = all_queries()[name](spark, sf).groupBy(F.spark_partition_id().alias("part")).count().collect()
        assert 4 < len(sizes) <= tasks and max(n for _, n in sizes) < 2 * 500, name
