"""What an analysis decides by itself: tags, ends, cutoff, rates; and the stored counts."""

import pytest
from pyspark.sql import functions as F

from foldmark.fixed_values import FIVE_PRIME_ENDS, MUT_TYPES, THREE_PRIME_ENDS
from foldmark.operators.rates import rate_matrix, reaggregate_rates
from foldmark.options import ReactivityOptions, conditions_for
from foldmark.plans import analysis as A
from foldmark.sinks import tables as T


def counts_df(spark, data):
    return spark.createDataFrame(data, "design_idx bigint, pos int, tag string, measure string, n bigint")


@pytest.fixture
def small(spark):
    counts = counts_df(spark, [(d, p, t, m, n) for d in (1, 2) for p in (1, 2, 3) for t, k in (("mod", 4), ("bg", 1))
                               for m, n in (("coverage", 100), ("AC", k * p))])
    library = spark.createDataFrame([(1, "ACG"), (2, "GCA")], "design_idx bigint, sequence string")
    return counts, library


@pytest.mark.parametrize("pair, tags", [
    (("modd", "bg"), None), (("mod", "bgg"), ["mod", "bg"]), (("mod", "bg"), ["mod", "bg", "bg"]),
])
def test_a_condition_without_exactly_one_tag_stops_every_table(spark, small, pair, tags):
    a = A.analyse(*small, conditions_for([pair]), ReactivityOptions(normalize=False), tags=tags)
    for table in (a.reactivity, a.coverage, a.rates, a.norm_cutoff):
        with pytest.raises(Exception, match="tag not matched once"):
            table.collect()


def test_tags_that_match_change_nothing(spark, small):
    for tags in (None, ["mod", "bg"], ["bg", "other", "mod"]):
        a = A.analyse(*small, conditions_for([("mod", "bg")]), ReactivityOptions(normalize=False), tags=tags)
        assert [r.r for r in a.reactivity.where("design_idx = 1").orderBy("pos").collect()] == pytest.approx([0.03, 0.06, 0.09])
        assert a.tags == (tags or [])


def test_ends_come_from_the_first_design(spark, small):
    counts, _ = small
    five, n5 = FIVE_PRIME_ENDS[0]
    three, n3 = THREE_PRIME_ENDS[0]
    library = spark.createDataFrame([(2, "ACG"), (1, five + "ACG" + three)], "design_idx bigint, sequence string")
    conditions, plain = conditions_for([("mod", "bg")]), ReactivityOptions(normalize=False)
    a = A.analyse(counts, library, conditions, plain, None, None)
    assert (a.blank5, a.blank3) == (n5, n3)
    b = A.analyse(counts, library, conditions, plain, None, 1)
    assert (b.blank5, b.blank3) == (n5, 1)
    assert A.constant_ends(library.where("design_idx = 2")) == (0, 0)


def test_cutoff_is_reported(spark, small):
    def cutoff(counts):
        return A.analyse(counts, small[1], conditions_for([("t",)]), ReactivityOptions(normalize=False)).norm_cutoff.first()[0]

    few = counts_df(spark, [(d, 1, "t", "coverage", 5000) for d in range(9)])
    many = counts_df(spark, [(d, 1, "t", "coverage", 5000) for d in range(10)])
    assert (cutoff(few), cutoff(many)) == (-1, 1000)


def test_types_without_counts_keep_their_coverage_in_merged_rates(spark):
    counts = counts_df(spark, [(1, 1, "a", "coverage", 10), (1, 1, "a", "AC", 5), (1, 1, "b", "coverage", 30), (1, 2, "b", "AC", 1)])
    rates = rate_matrix(counts)
    assert rates.count() == 2 * len(MUT_TYPES)
    merged = reaggregate_rates(rates.withColumn("tag", F.lit("ab")), ["pos", "tag", "measure"])
    got = {r.measure: (r.rate, r.coverage) for r in merged.collect()}
    assert got["AC"] == (5 / 40, 40) and got["del"] == (0.0, 40)


def test_stored_counts_come_back_by_range_and_tag(spark, tmp_path):
    data = [(d, 1, t, m, d + 1) for d in range(50) for t in ("1", "x y") for m in ("coverage", "AC")]
    path = str(tmp_path / "counts")
    T.write_counts_table(counts_df(spark, data), path)
    back = T.read_counts_table(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(data) and dict(back.dtypes)["tag"] == "string"
    part = T.read_counts_table(spark, path, tags=["1"], measures=["AC"], first=10, last=19)
    assert sorted(map(tuple, part.collect())) == [r for r in sorted(data) if r[2] == "1" and r[3] == "AC" and 10 <= r[0] <= 19]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(design_idx,10)" in plan and "PartitionFilters: [" in plan
    T.write_counts_table(counts_df(spark, data).limit(0), str(tmp_path / "none"))
    assert T.read_counts_table(spark, str(tmp_path / "none")).count() == 0
