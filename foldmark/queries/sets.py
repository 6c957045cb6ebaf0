"""Queries over merging, rates, summaries and data set algebra."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import algebra as G
from ..operators import merge as M
from ..operators import normalize as N
from ..operators import rates as T
from ..operators import reactivity as R
from ..operators import stats as Q
from ..operators import subdivide as D
from ..options import conditions_for
from ..plans import analysis as A
from ..session import written
from ..sinks.bundle import settle
from . import views as V
from .core import _BLANKED, _NORM_SQL, _NORMED, _NV
from .registry import query

_COUNTS_SQL = f"""SELECT l_partkey + 1 AS design_idx, l_linenumber AS pos, l_returnflag AS tag, 'coverage' AS measure,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem {{where}} GROUP BY ALL
UNION ALL SELECT l_partkey + 1, l_linenumber, l_returnflag, {V._TYPE_LIST}[CAST(l_suppkey % 14 + 1 AS INT)], count(*)
FROM lineitem {{where}} GROUP BY ALL"""


def _splits(spark, sf):
    """The counts of four splits, as separate tables."""
    c = V.counts(spark, sf, split=True)
    return [c.where(F.col("split") == i).drop("split") for i in range(4)]


@query("a01_merge_counts", _COUNTS_SQL.format(where=""))
def merge_counts(spark, sf):
    return M.merge_counts(*_splits(spark, sf))


@query("a03_merge_counts_range", f"""SELECT CAST((design_idx - 1) // 500 * 500 + 1 AS BIGINT) AS first_design, tag, measure,
  CAST(sum(n) AS BIGINT) AS n FROM ({_COUNTS_SQL.format(where='')}) GROUP BY ALL""")
def merge_by_range(spark, sf):
    merged = M.merge_counts(*_splits(spark, sf))
    return merged.groupBy(M.range_label(500).alias("first_design"), "tag", "measure").agg(F.sum("n").alias("n"))


@query("j11_outer_add", _COUNTS_SQL.format(where=""))
def outer_add(spark, sf):
    c = V.counts(spark, sf, split=True)
    return M.merge_counts(c.where("split < 2"), c.where("split >= 2"))


@query("u09_lane_merge", f"""SELECT tag, measure, count(*) AS cells, CAST(sum(n) AS BIGINT) AS n
FROM ({_COUNTS_SQL.format(where='')}) GROUP BY ALL""")
def lane_merge(spark, sf):
    s = _splits(spark, sf)
    lanes = [M.merge_counts(s[0], s[2]), M.merge_counts(s[1], s[3])]
    return M.merge_counts(*lanes).groupBy("tag", "measure").agg(
        F.count("*").alias("cells"), F.sum("n").alias("n")
    )


@query("u07_concat_ranges", _COUNTS_SQL.format(where=""))
def concat_ranges(spark, sf):
    c = V.counts(spark, sf)
    return M.design_range(c, 1, 700).unionByName(c.where(F.col("design_idx") > 700))


@query("f08_seq_range", _COUNTS_SQL.format(where="WHERE l_partkey + 1 >= 101"))
def seq_range(spark, sf):
    return M.design_range(V.counts(spark, sf), 101, 10**12)


@query("a04_total_counts", f"""WITH {V.COV}, {V.COVMAX} SELECT t AS tag, CAST(sum(coverage) AS BIGINT) AS total
FROM covmax GROUP BY ALL""")
def total_counts(spark, sf):
    return M.total_counts(V.counts(spark, sf))


def _tensor(spark, sf):
    li = V.table(spark, sf, "lineitem")
    return li.groupBy(
        (F.col("l_partkey") + 1).alias("design_idx"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("tag"),
        F.element_at(F.array(*map(F.lit, "ACGT")), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("ref"),
        F.element_at(F.array(*map(F.lit, ["A", "C", "G", "T", "del", "ins"])),
                     (F.col("l_quantity").cast("int") % 6 + 1)).alias("read"),
    ).agg(F.count("*").alias("n"))


_TENSOR = """tensor AS (
  SELECT l_partkey + 1 AS design_idx, l_linenumber AS pos, l_returnflag AS tag,
    ['A', 'C', 'G', 'T'][CAST(l_suppkey % 4 + 1 AS INT)] AS ref,
    ['A', 'C', 'G', 'T', 'del', 'ins'][CAST(l_quantity AS INT) % 6 + 1] AS read, count(*) AS n
  FROM lineitem GROUP BY ALL)"""


@query("a04_total_tensor_counts", f"""WITH {_TENSOR} SELECT tag, CAST(sum(n) AS BIGINT) AS total FROM (
  SELECT tag, design_idx, ref, read, max(n) AS n FROM tensor WHERE read <> 'ins' GROUP BY ALL) GROUP BY tag""")
def total_tensor(spark, sf):
    return M.total_tensor_counts(_tensor(spark, sf))


@query("a22_tensor_to_types", f"""WITH {_TENSOR}, m AS (
  SELECT *, CASE WHEN read IN ('del', 'ins') THEN read WHEN ref <> read THEN ref || read END AS measure FROM tensor
  UNION ALL SELECT *, 'coverage' FROM tensor WHERE read <> 'ins'
  UNION ALL SELECT *, 'muts' FROM tensor WHERE ref <> read AND read <> 'ins')
SELECT design_idx, pos, tag, measure, CAST(sum(n) AS BIGINT) AS n FROM m WHERE measure IS NOT NULL GROUP BY ALL""")
def tensor_types(spark, sf):
    return M.tensor_to_measures(_tensor(spark, sf))


# Rates and summaries -------------------------------------------------------------------------------

_RATES = """posc AS (SELECT p, t, CAST(sum(c) AS BIGINT) AS c FROM cov GROUP BY ALL),
posk AS (SELECT p, t, k, CAST(sum(n) AS BIGINT) AS n FROM rc GROUP BY ALL
         UNION ALL SELECT p, t, 'muts', CAST(sum(n) AS BIGINT) FROM rc WHERE k <> 'ins' GROUP BY ALL),
rates AS (SELECT posk.p, posk.t, k, n / c AS rate, c FROM posk JOIN posc ON posc.p = posk.p AND posc.t = posk.t)"""


def _rates(spark, sf):
    return T.position_rates(R.with_muts(V.counts(spark, sf)))


@query("a15_mut_rate_matrix", f"""WITH {V.COV}, {V.RC}, {_RATES} SELECT p AS pos, t AS tag, k AS measure,
  round(rate, 9) AS rate, c AS coverage FROM rates""")
def mut_rate_matrix(spark, sf):
    return V.rounded(_rates(spark, sf), "rate")


_MEANS = f"""{_RATES}, means AS (
  SELECT t, k, sum(rate) / max(np) AS m
  FROM rates JOIN (SELECT t, count(DISTINCT p) AS np FROM posc WHERE p BETWEEN 2 AND 6 GROUP BY t) USING (t)
  WHERE p BETWEEN 2 AND 6 GROUP BY ALL),
summary AS (
  SELECT t, coalesce(sum(m) FILTER (k NOT IN ('ins', 'del', 'muts')), 0) AS mut, coalesce(sum(m) FILTER (k = 'ins'), 0) AS ins,
    coalesce(sum(m) FILTER (k = 'del'), 0) AS del, coalesce(sum(m) FILTER (k NOT IN ('ins', 'muts')), 0) AS mut_del,
    coalesce(sum(m) FILTER (k = 'muts'), 0) AS counted FROM means GROUP BY ALL)"""


@query("a16_mean_mut_rate_by_type", f"""WITH {V.COV}, {V.RC}, {_MEANS} SELECT t AS tag, k AS measure,
  round(m, 9) AS mean_rate FROM means""")
def mean_rates(spark, sf):
    return V.rounded(T.mean_rates_by_type(_rates(spark, sf), 7, 1, 1), "mean_rate")


_DENSE_COV = """dense AS (SELECT part.p_partkey + 1 AS d, v.t, coalesce(covmax.coverage, 0) AS coverage
  FROM part CROSS JOIN (VALUES ('A'), ('N'), ('R')) AS v(t) LEFT JOIN covmax ON covmax.d = p_partkey + 1 AND covmax.t = v.t)"""


@query("a17_stats_by_tag", f"""WITH {V.COV}, {V.RC}, {V.COVMAX}, {_DENSE_COV}, {_MEANS}
SELECT t AS tag, CAST(sum(coverage) AS BIGINT) AS reads, round(avg(coverage), 9) AS mean_reads,
  CAST(floor(median(coverage)) AS BIGINT) AS median_reads, round(avg(coverage) / median(coverage), 9) AS mean_to_median,
  any_value(round(mut, 9)) AS mut, any_value(round(ins, 9)) AS ins, any_value(round(del, 9)) AS del,
  any_value(round(mut_del, 9)) AS mut_del, any_value(round(counted, 9)) AS counted
FROM dense JOIN summary USING (t) GROUP BY t""")
def stats_by_tag(spark, sf):
    dense = Q.dense_design_values(
        V.part_library(spark, sf), N.coverage_by_tag(V.counts(spark, sf)), "tag", ["A", "N", "R"], "coverage")
    rates = T.rate_summary(T.mean_rates_by_type(_rates(spark, sf), 7, 1, 1))
    out = Q.tag_stats(dense).join(F.broadcast(rates), "tag")
    return V.rounded(out, "mean_reads", "mean_to_median", "mut", "ins", "del", "mut_del", "counted")


def _analysis(spark, sf, conditions=V.CONDITIONS, counts=None, library=None):
    counts = written(V.counts(spark, sf), "counts") if counts is None else counts
    library = V.part_library(spark, sf) if library is None else library
    return replace(A.analyse(counts, library, conditions, blank5=1, blank3=1), tags=["A", "N", "R"])


def _settled(*args):
    return settle(_analysis(*args), ("reactivity", "norm_val"))


_SN = V.SN.format(rows="(SELECT * FROM full_r WHERE p > 1 AND p <= 6)")
_QUALITY = f"""{_NORM_SQL}, {_BLANKED}, {_NV}, {_SN}, {V.READS},
quality AS (SELECT part.p_partkey + 1 AS d, v.cond_idx, coalesce(sn.signal_to_noise, 0) AS signal_to_noise,
    coalesce(reads.reads, 0) AS reads
  FROM part CROSS JOIN (VALUES (1), (2), (3)) AS v(cond_idx)
  LEFT JOIN sn ON sn.d = p_partkey + 1 AND sn.cond_idx = v.cond_idx
  LEFT JOIN reads ON reads.d = p_partkey + 1 AND reads.cond_idx = v.cond_idx)"""


def _dense_reads(a):
    return Q.dense_design_values(a.library, a.reads, "cond_idx", [c.cond_idx for c in a.conditions], "reads")


@query("a18_stats_by_condition", f"""WITH {_QUALITY},
lev AS (SELECT cond_idx, avg(r / norm_val) * any_value(norm_val) AS mean_react FROM blanked JOIN nv USING (cond_idx) GROUP BY ALL),
med AS (SELECT cond_idx, median(r / norm_val) AS median_norm FROM blanked JOIN nv USING (cond_idx)
  JOIN (SELECT d, cond_idx FROM quality WHERE signal_to_noise > 1) USING (d, cond_idx) WHERE r IS NOT NULL GROUP BY ALL),
q AS (SELECT cond_idx, CAST(sum(reads) AS BIGINT) AS reads, avg(reads) AS mean_reads,
    CAST(floor(median(reads)) AS BIGINT) AS median_reads, avg(reads) / median(reads) AS mean_to_median,
    avg(signal_to_noise) AS mean_sn, avg(CASE WHEN signal_to_noise > 1 THEN 1 ELSE 0 END) AS frac_sn1
  FROM quality GROUP BY ALL)
SELECT cond_idx, reads, round(mean_reads, 9) AS mean_reads, median_reads, round(mean_to_median, 9) AS mean_to_median,
  round(norm_val, 9) AS norm_val, round(mean_react, 9) AS mean_react, round(median_norm, 9) AS median_norm,
  round(mean_sn, 9) AS mean_sn, round(frac_sn1, 9) AS frac_sn1
FROM q LEFT JOIN nv USING (cond_idx) LEFT JOIN lev USING (cond_idx) LEFT JOIN med USING (cond_idx)""")
def stats_by_condition(spark, sf):
    a = settle(_settled(spark, sf), ("signal_to_noise",))
    out = Q.condition_stats(_dense_reads(a), a.reactivity, a.signal_to_noise, a.norm_val)
    return V.rounded(out, "mean_reads", "mean_to_median", "norm_val", "mean_react", "median_norm", "mean_sn", "frac_sn1")


def _quality(spark, sf, strict_reads=False, sn_cutoff=1.0):
    a = _analysis(spark, sf)
    return Q.quality_pass(a.signal_to_noise, _dense_reads(a), sn_cutoff=sn_cutoff, strict_reads=strict_reads)


@query("f03_filter_quality_good", f"""WITH {_QUALITY} SELECT d AS design_idx, cond_idx FROM quality
WHERE signal_to_noise >= 1 AND reads >= 100""")
def quality_good(spark, sf):
    return _quality(spark, sf).where("passes").select("design_idx", "cond_idx")


@query("u05_except_idx", f"""WITH {_QUALITY} SELECT d AS design_idx, cond_idx, 'warning:badQuality' AS annotation
FROM quality WHERE NOT (signal_to_noise >= 1 AND reads >= 100)""")
def quality_bad(spark, sf):
    q = _quality(spark, sf)
    bad = q.where(~F.col("passes"))
    return bad.select("design_idx", "cond_idx", F.lit("warning:badQuality").alias("annotation"))


@query("u04_intersect_idx", f"""WITH {_QUALITY} SELECT d AS design_idx FROM quality
WHERE cond_idx = 1 AND signal_to_noise >= 0.2 AND reads >= 100
INTERSECT SELECT d FROM quality WHERE cond_idx = 2 AND signal_to_noise >= 0.2 AND reads >= 100""")
def quality_intersect(spark, sf):
    good = _quality(spark, sf, sn_cutoff=0.2).where("passes")
    return good.where("cond_idx = 1").select("design_idx").intersect(good.where("cond_idx = 2").select("design_idx"))


@query("f04_filter_quality_heatmap", f"""WITH {_QUALITY}, picked AS (
  SELECT d, row_number() OVER (ORDER BY d) AS k FROM quality
  WHERE cond_idx = 3 AND signal_to_noise >= 1 AND reads > 100)
SELECT d AS design_idx, k AS ordinal FROM picked""")
def heatmap(spark, sf):
    return Q.heatmap_designs(_quality(spark, sf, strict_reads=True), 3)


@query("a28_cutoff_pass_rate", f"""WITH {_QUALITY} SELECT cond_idx,
  count(*) FILTER (signal_to_noise >= 1 AND reads >= 100) AS passing, count(*) AS designs,
  round(100.0 * count(*) FILTER (signal_to_noise >= 1 AND reads >= 100) / count(*), 9) AS percent
FROM quality GROUP BY ALL""")
def cutoff_pass(spark, sf):
    return V.rounded(Q.pass_rate(_quality(spark, sf)), "percent")


@query("a29_sn_histogram", f"""WITH {_QUALITY} SELECT cond_idx,
  CAST(CASE WHEN signal_to_noise < -2.013 THEN 0 WHEN signal_to_noise >= 4.017 THEN 13
       ELSE floor((signal_to_noise + 2.013) * 12 / 6.03) + 1 END AS INT) AS bin, count(*) AS designs FROM quality GROUP BY ALL""")
def sn_histogram(spark, sf):
    return Q.signal_histogram(_analysis(spark, sf).signal_to_noise, -2.013, 4.017, 12)


_ARGMAX = f"""WITH {_QUALITY} SELECT d AS design_idx, round(sum(signal_to_noise), 9) AS total FROM quality
GROUP BY d ORDER BY round(sum(signal_to_noise), 12) DESC, d LIMIT 1"""


@query("a30_argmax_design", _ARGMAX)
def argmax_design(spark, sf):
    return V.rounded(Q.best_design(_analysis(spark, sf).signal_to_noise), "total")


query("o04_top1_summed_signal", _ARGMAX)(argmax_design)


# Data set algebra ----------------------------------------------------------------------------------

@query("u01_concat_designs", _NORMED)
def concat_designs(spark, sf):
    counts, lib = written(V.counts(spark, sf), "counts"), V.part_library(spark, sf)
    half = lib.count() // 2

    def part(df, second):
        if second:
            return df.where(F.col("design_idx") > half).withColumn("design_idx", F.col("design_idx") - half)
        return df.where(F.col("design_idx") <= half)

    sets = [(_settled(spark, sf, V.CONDITIONS, part(counts, s), part(lib, s)), half) for s in (False, True)]
    out = G.concat_designs(sets).reactivity.drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


_COND2 = _NORMED.replace("(2, 'R', 'N'), (3, 'R', NULL)", "(2, 'R', NULL)")


@query("u02_combine_conditions", _COND2)
def combine_conditions(spark, sf):
    counts = written(V.counts(spark, sf), "counts")
    sets = []
    for pair in (("A", "N"), ("R",)):
        own = counts.where(F.col("tag").isin(list(pair)))
        sets.append(replace(_settled(spark, sf, conditions_for([pair]), own), tags=list(pair)))
    out = G.combine_conditions(*sets).reactivity.drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


_MERGED_TOTALS = """totals AS (
  SELECT d, CAST(sum(coverage * CASE WHEN t = 'N' THEN 2 ELSE 1 END) AS BIGINT) AS total_coverage
  FROM covmax GROUP BY ALL)"""
_WM = """wm AS (SELECT d, p, b, 1 AS cond_idx, sum(r / (re * re)) / sum(1 / (re * re)) AS r,
  sqrt(1 / sum(1 / (re * re))) AS re FROM blanked WHERE cond_idx IN (1, 2) GROUP BY d, p, b),
inwm AS (SELECT * FROM wm SEMI JOIN normset USING (d))"""
_MERGED = f"""{V.FULL}, {V.COVMAX}, {_MERGED_TOTALS}, {V.NORMSET}, {_BLANKED}, {_WM}, {V.norm_values_sql('inwm')},
wmn AS (SELECT d, p, b, cond_idx, r / norm_val AS r, re / norm_val AS re FROM wm LEFT JOIN nv USING (cond_idx))"""


def _merged(spark, sf, renorm=True):
    return G.merge_conditions(_settled(spark, sf), [[1, 2]], renorm=renorm)


@query("u03_merge_conditions", f"""WITH {_MERGED} SELECT d AS design_idx, CAST(p AS INT) AS pos, b AS base, cond_idx,
  round(r, 9) + 0.0 AS r, round(re, 9) AS r_err FROM wmn""")
def merge_conditions(spark, sf):
    return V.rounded(_merged(spark, sf).reactivity.drop("seq_len"), "r", "r_err")


@query("u03_merged_signal", f"""WITH {_MERGED}, {V.SN.format(rows="(SELECT * FROM wmn)")}
SELECT d AS design_idx, cond_idx, round(signal_to_noise, 9) + 0.0 AS signal_to_noise FROM sn""")
def merged_signal(spark, sf):
    return V.rounded(_merged(spark, sf).signal_to_noise, "signal_to_noise")


@query("u03_merge_legacy", f"""WITH {_NORM_SQL}, {_BLANKED}, {_NV},
z AS (SELECT d, p, b, r / norm_val AS r, re / norm_val AS re FROM blanked JOIN nv USING (cond_idx) WHERE cond_idx IN (1, 2))
SELECT d AS design_idx, CAST(p AS INT) AS pos, b AS base, 1 AS cond_idx,
  round(sum(r / (re * re)) / sum(1 / (re * re)), 9) + 0.0 AS r, round(sqrt(1 / sum(1 / (re * re))), 9) AS r_err
FROM z GROUP BY d, p, b""")
def merge_legacy(spark, sf):
    return V.rounded(_merged(spark, sf, renorm=False).reactivity.drop("seq_len"), "r", "r_err")


@query("a19_weighted_mean", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT}
SELECT d AS design_idx, p AS pos, round(sum(r / (re * re)) / sum(1 / (re * re)), 9) + 0.0 AS r,
  round(sqrt(1 / sum(1 / (re * re))), 9) AS r_err FROM react GROUP BY d, p""")
def weighted_mean(spark, sf):
    r = R.combine_profiles(R.subtract_background(V.counts(spark, sf), V.CONDITIONS, tasks=V.count_tasks(spark, sf)))
    return V.rounded(G.weighted_mean(r, ["design_idx", "pos"]), "r", "r_err")


@query("a20_rate_reaggregate", f"""WITH {V.COV}, {V.RC}, {_RATES} SELECT p AS pos, t AS tag, k AS measure,
  round(rate, 9) AS rate FROM rates""")
def rate_reaggregate(spark, sf):
    c = R.with_muts(V.counts(spark, sf))
    halves = [T.position_rates(c.where(F.col("design_idx") % 2 == i)) for i in (0, 1)]
    out = T.reaggregate_rates(halves[0].unionByName(halves[1]), ["pos", "tag", "measure"])
    return V.rounded(out.drop("coverage"), "rate")


@query("a13_renormalize", _NORMED)
def renormalize(spark, sf):
    a = _settled(spark, sf)
    out = G.renormalize(a, G.denormalized(a)).reactivity.drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


_SLICED = _NORMED.replace("FROM covmax GROUP BY ALL)",
                          "FROM covmax JOIN part ON p_partkey + 1 = d AND p_size > 25 GROUP BY ALL)") \
    .replace("FROM blanked LEFT JOIN nv", "FROM blanked JOIN part ON p_partkey + 1 = d AND p_size > 25 LEFT JOIN nv")


@query("f07_slice_designs", _SLICED)
def slice_designs(spark, sf):
    chosen = V.table(spark, sf, "part").where("p_size > 25").select((F.col("p_partkey") + 1).alias("design_idx"))
    out = G.slice_designs(_settled(spark, sf), chosen).reactivity.drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


@query("u06_union_idx", f"""WITH {V.COND}, used AS (SELECT s AS t FROM cond UNION SELECT n FROM cond WHERE n IS NOT NULL), {V.COV}
SELECT t AS tag, count(*) AS cells, CAST(sum(c) AS BIGINT) AS coverage FROM cov JOIN used USING (t) GROUP BY ALL""")
def union_idx(spark, sf):
    c = V.counts(spark, sf).where("measure = 'coverage'")
    used = R.role_table(spark, V.CONDITIONS).select("tag").distinct()
    return c.join(F.broadcast(used), "tag", "left_semi").groupBy("tag").agg(
        F.count("*").alias("cells"), F.sum("n").alias("coverage"))


@query("j10_assert_aligned_sequences", f"""WITH {V.LIB}, b AS (SELECT design_idx + 3 AS design_idx, sequence FROM lib)
SELECT design_idx, lib.sequence AS left_sequence, b.sequence AS right_sequence
FROM lib FULL JOIN b USING (design_idx) WHERE lib.sequence IS DISTINCT FROM b.sequence""")
def aligned_sequences(spark, sf):
    lib = V.documents(spark, sf)
    return G.unequal_sequences(lib, lib.withColumn("design_idx", F.col("design_idx") + 3))


# Sub-libraries -------------------------------------------------------------------------------------

_TAGGED = """tagged AS (SELECT doc_id + 1 AS design_idx, lang, source, CASE WHEN lang <> 'en'
  THEN doc_id || ' sublibrary:' || source || ', ' || lang ELSE CAST(doc_id AS VARCHAR) END AS header FROM documents)"""
_SUBLIB = "CASE WHEN lang <> 'en' THEN source ELSE 'unassigned' END"


def _tagged(spark, sf):
    doc = F.col("doc_id").cast("string")
    return V.table(spark, sf, "documents").select(
        (F.col("doc_id") + 1).alias("design_idx"),
        F.when(F.col("lang") != "en", F.concat(doc, F.lit(" sublibrary:"), "source", F.lit(", "), "lang"))
        .otherwise(doc).alias("header"),
    )


@query("a27_sublibrary_group", f"""WITH {_TAGGED} SELECT {_SUBLIB} AS sublibrary, count(*) AS designs,
  min(design_idx) AS first_design FROM tagged GROUP BY ALL""")
def sublibrary_group(spark, sf):
    return D.sublibrary_sizes(_tagged(spark, sf))


@query("j05_semi_sublibrary", f"""WITH {_TAGGED} SELECT * FROM ({_COUNTS_SQL.format(where='')}) c
WHERE design_idx IN (SELECT design_idx FROM tagged WHERE {_SUBLIB} <> 'unassigned')""")
def semi_sublibrary(spark, sf):
    lib = _tagged(spark, sf)
    chosen = lib.where(D.sublibrary(F.col("header")) != D.UNASSIGNED)
    return D.restrict_to(V.counts(spark, sf), chosen)


@query("k03_subdivide_counts", f"""WITH {_TAGGED} SELECT {_SUBLIB} AS sublibrary, tag, measure, count(*) AS cells,
  CAST(sum(n) AS BIGINT) AS n FROM ({_COUNTS_SQL.format(where='')}) c JOIN tagged USING (design_idx) GROUP BY ALL""")
def subdivide_counts(spark, sf):
    return D.split_counts(V.counts(spark, sf), _tagged(spark, sf)).groupBy("sublibrary", "tag", "measure").agg(
        F.count("*").alias("cells"), F.sum("n").alias("n"))


@query("f06_filter_header_contains", f"""WITH {_TAGGED} SELECT design_idx, header FROM tagged
WHERE contains(header, 'sublibrary:src1')""")
def header_contains(spark, sf):
    return D.headers_with(_tagged(spark, sf), "sublibrary:src1")


@query("o03_first_designs", f"""WITH {V.LIB} SELECT design_idx, header, sequence,
  row_number() OVER (ORDER BY design_idx) AS ordinal FROM lib""")
def first_designs(spark, sf):
    return Q.numbered_designs(V.documents(spark, sf).select("design_idx", "header", "sequence"))


# Run reports ---------------------------------------------------------------------------------------

_FUNNEL = """funnel AS (SELECT CAST(list_position(['view', 'click', 'signup', 'purchase', 'error'], event_type) AS INT) AS stage_no,
  event_type AS stage, count(*) AS n_reads FROM events GROUP BY ALL)"""


def _stages(spark, sf):
    no = F.array_position(F.array(*map(F.lit, V.STAGES)), F.col("event_type")).cast("int")
    return V.table(spark, sf, "events").groupBy(no.alias("stage_no"), F.col("event_type").alias("stage")).agg(
        F.count("*").alias("n_reads"))


_LAG = f"""WITH {_FUNNEL} SELECT stage_no, stage, n_reads,
  round(100.0 * n_reads / lag(n_reads) OVER (ORDER BY stage_no), 9) AS percent FROM funnel"""


@query("w06_lag_percent", _LAG)
def lag_percent(spark, sf):
    return V.rounded(Q.funnel(_stages(spark, sf)), "percent")


@query("a25_funnel_stats", f"""WITH {_FUNNEL} SELECT min(n_reads) AS least, max(n_reads) AS most,
  round(100.0 * min(n_reads) / max(n_reads), 9) AS percent FROM funnel""")
def funnel_overall(spark, sf):
    return V.rounded(Q.overall_yield(_stages(spark, sf)), "percent")


_FILES = """files AS (
  SELECT 'run/' || user_id AS directory,
    CASE event_type WHEN 'error' THEN 'run.err' WHEN 'view' THEN 'run.out' ELSE event_type || '.log' END AS file,
    CAST(floor(greatest(value - 5, 0)) AS BIGINT) AS size FROM events),
review AS (
  SELECT directory, count(*) FILTER (file = 'run.out') = 0 AS no_run,
    coalesce(max(size) FILTER (file = 'run.err'), 0) > 0 AS has_error,
    coalesce(max(size) FILTER (file = 'run.out'), 1) = 0 AS empty_out FROM files GROUP BY directory)"""


def _files(spark, sf):
    return V.table(spark, sf, "events").select(
        F.concat(F.lit("run/"), F.col("user_id").cast("string")).alias("directory"),
        F.when(F.col("event_type") == "error", "run.err").when(F.col("event_type") == "view", "run.out")
        .otherwise(F.concat("event_type", F.lit(".log"))).alias("file"),
        F.floor(F.greatest(F.col("value") - 5, F.lit(0.0))).cast("bigint").alias("size"),
    )


@query("a26_run_review", f"""WITH {_FILES} SELECT count(*) AS directories, count(*) FILTER (NOT no_run) AS with_run,
  count(*) FILTER (no_run) AS without_run, count(*) FILTER (has_error) AS with_error,
  count(*) FILTER (empty_out) AS with_empty_out, count(*) FILTER (no_run OR has_error OR empty_out) AS problems FROM review""")
def run_review(spark, sf):
    return Q.review_counts(Q.run_review(_files(spark, sf)))


@query("u08_distinct_problem_dirs", f"""WITH {_FILES} SELECT directory FROM review WHERE no_run
UNION SELECT directory FROM review WHERE has_error UNION SELECT directory FROM review WHERE empty_out""")
def problem_dirs(spark, sf):
    return Q.run_review(_files(spark, sf)).where("problem").select("directory")


@query("o06_largest_first", f"WITH {_FILES} SELECT directory, max(size) AS size FROM files GROUP BY directory ORDER BY size DESC, directory")
def largest_first(spark, sf):
    return _files(spark, sf).groupBy("directory").agg(F.max("size").alias("size")).orderBy(F.desc("size"), "directory")


@query("o05_sorted_distinct_files", f"WITH {_FILES} SELECT DISTINCT directory || '/' || file AS path FROM files ORDER BY 1")
def sorted_files(spark, sf):
    return _files(spark, sf).select(F.concat_ws("/", "directory", "file").alias("path")).distinct().orderBy("path")


_READABLE = """CASE WHEN x = 0 THEN '0' ELSE printf('%.1f', x / pow(1000, e)) || ['', 'k', 'M', 'B', 'T'][e + 1] END"""


@query("e12_human_readable", f"""SELECT o_custkey, {_READABLE} AS readable FROM (
  SELECT o_custkey, x, CAST(CASE WHEN x >= 1e12 THEN 4 WHEN x >= 1e9 THEN 3 WHEN x >= 1e6 THEN 2 WHEN x >= 1e3 THEN 1 ELSE 0 END AS INT) AS e
  FROM (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS x FROM orders GROUP BY ALL))""")
def readable(spark, sf):
    sums = V.table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice")).alias("x"))
    return sums.select("o_custkey", Q.human_readable(F.col("x")).alias("readable"))
