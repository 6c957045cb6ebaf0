"""Queries over reactivity, spreading, signal and normalization."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import FIVE_PRIME_ENDS, NORM_MAX_SEQUENCES, THREE_PRIME_ENDS
from ..operators import normalize as N
from ..operators import reactivity as R
from ..operators import spread as S
from ..operators.ordinals import nearest_rank
from ..operators.signal import classify_signal, signal_to_noise
from ..options import ReactivityOptions
from ..plans import analysis as A
from ..session import written
from . import views as V
from .registry import query


def _sub(spark, sf, **options):
    return R.subtract_background(V.counts(spark, sf), V.CONDITIONS, ReactivityOptions(**options),
                                 tasks=V.count_tasks(spark, sf))


def _react(spark, sf):
    """Reactivity with deletions left where they are recorded."""
    return R.combine_profiles(_sub(spark, sf))


def _sn(spark, sf):
    return signal_to_noise(_react(spark, sf).withColumn("seq_len", F.lit(7)), None, 0, 0)


SN_SQL = ", ".join([V.COV, V.RC, V.COND, V.TAGS, V.SUB, V.REACT, V.SN.format(rows="react")])


@query("a05_coverage_max", f"WITH {V.COV}, {V.COVMAX} SELECT d AS design_idx, t AS tag, coverage FROM covmax")
def coverage_max(spark, sf):
    return N.coverage_by_tag(V.counts(spark, sf))


@query("a06_total_coverage", f"WITH {V.COV}, {V.COVMAX}, {V.TOTALS} SELECT d AS design_idx, total_coverage FROM totals")
def total_coverage(spark, sf):
    return N.total_coverage(N.coverage_by_tag(V.counts(spark, sf)))


@query("a07_reads_per_condition",
       f"WITH {V.COV}, {V.COND}, {V.COVMAX}, {V.READS} SELECT d AS design_idx, cond_idx, reads FROM reads")
def reads_per_condition(spark, sf):
    return A.reads_per_condition(N.coverage_by_tag(V.counts(spark, sf)), V.CONDITIONS)


_F_SQL = """SELECT c.d AS design_idx, c.p AS pos, c.t AS tag, round(n / c, 9) AS f,
  round(sqrt(n) / c, 9) AS f_err, round(1.0 / c, 9) AS f_floor
FROM (SELECT c.d, c.p, c.t, c.c, coalesce(sum(n) FILTER ({types}), 0) AS n
      FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL) c"""


def _fraction(**options):
    def run(spark, sf):
        f = R.mutation_fraction(V.counts(spark, sf), ReactivityOptions(**options))
        return V.rounded(f, "f", "f_err", "f_floor")
    return run


for _name, _types, _opts in (
    ("a08_mut_fraction", "k <> 'ins'", {}),
    ("a08_mut_fraction_no_ga", "k NOT IN ('ins', 'GA')", {"no_GA": True}),
    ("a08_mut_fraction_only_ga", "k = 'GA'", {"only_GA": True}),
    ("a08_mut_fraction_only_ag", "k = 'AG'", {"only_AG": True}),
):
    query(_name, f"WITH {V.COV}, {V.RC} " + _F_SQL.format(types=_types))(_fraction(**_opts))


@query("a09_strictmut_del_split",
       f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}
SELECT d AS design_idx, p AS pos, cond_idx, round(st, 9) + 0.0 AS strict, round(se, 9) AS strict_err,
  round(de, 9) + 0.0 AS del, round(dee, 9) AS del_err FROM sub""")
def strict_del(spark, sf):
    out = _sub(spark, sf).select("design_idx", "pos", "cond_idx", "strict", "strict_err", "del", "del_err")
    return V.rounded(out, "strict", "strict_err", "del", "del_err")


@query("p05_background_subtraction",
       f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT}
SELECT d AS design_idx, p AS pos, cond_idx, round(r, 9) + 0.0 AS r, round(re, 9) AS r_err,
  round(nomod, 9) AS r_nomod FROM react""")
def background(spark, sf):
    return V.rounded(_react(spark, sf), "r", "r_err", "r_nomod")


@query("a10_signal_to_noise",
       f"WITH {SN_SQL} SELECT d AS design_idx, cond_idx, round(signal_to_noise, 9) + 0.0 AS signal_to_noise FROM sn")
def signal(spark, sf):
    return V.rounded(_sn(spark, sf), "signal_to_noise")


@query("e08_ratio", f"""WITH {V.COV}, {V.RC} SELECT rc.d AS design_idx, rc.p AS pos, rc.t AS tag, k AS measure,
  round(n / c, 9) AS frc FROM rc JOIN cov ON rc.d = cov.d AND rc.p = cov.p AND rc.t = cov.t""")
def elementwise_ratio(spark, sf):
    return V.rounded(R.type_fractions(V.counts(spark, sf)), "frc").drop("frc_err")


@query("e09_poisson_error", f"""WITH {V.COV}, {V.RC} SELECT rc.d AS design_idx, rc.p AS pos, rc.t AS tag,
  k AS measure, round(sqrt(n) / c, 9) AS frc_err
FROM rc JOIN cov ON rc.d = cov.d AND rc.p = cov.p AND rc.t = cov.t""")
def poisson_error(spark, sf):
    return V.rounded(R.type_fractions(V.counts(spark, sf)), "frc_err").drop("frc")


@query("e10_quadrature_sum", f"""WITH {V.COV}, {V.RC} SELECT rc.d AS design_idx, rc.p AS pos, rc.t AS tag,
  round(sqrt(sum(n) / max(c * c)), 9) AS err
FROM rc JOIN cov ON rc.d = cov.d AND rc.p = cov.p AND rc.t = cov.t GROUP BY ALL""")
def quadrature(spark, sf):
    errs = R.type_fractions(V.counts(spark, sf))
    out = errs.groupBy("design_idx", "pos", "tag").agg(R.quadrature_sum("frc_err").alias("err"))
    return V.rounded(out, "err")


@query("e11_classify_signal", f"""WITH {SN_SQL} SELECT d AS design_idx, cond_idx,
  CASE WHEN signal_to_noise = 0 THEN 'N/A' WHEN signal_to_noise < 1 THEN 'weak' WHEN signal_to_noise < 5 THEN 'medium'
       WHEN signal_to_noise < 10 THEN 'good' ELSE 'strong' END AS signal_class FROM sn""")
def classify(spark, sf):
    return _sn(spark, sf).select("design_idx", "cond_idx", classify_signal(F.col("signal_to_noise")).alias("signal_class"))


@query("j01_join_treated_control", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}
SELECT s.d AS design_idx, s.p AS pos, cond.cond_idx, CAST(s.st + s.de AS BIGINT) AS n_treated, s.c AS c_treated,
  CAST(coalesce(n.st + n.de, 0) AS BIGINT) AS n_control, coalesce(n.c, 0) AS c_control
FROM cond JOIN tags s ON s.t = cond.s LEFT JOIN tags n ON n.t = cond.n AND n.d = s.d AND n.p = s.p""")
def treated_control(spark, sf):
    o = ReactivityOptions()
    pairs = R.pair_counts(V.counts(spark, sf), V.CONDITIONS, {"n": [*o.mismatches, "del"], "c": ["coverage"]},
                          tasks=V.count_tasks(spark, sf))
    return pairs.where(F.col("c_s") > 0).select(
        "design_idx", "pos", "cond_idx", F.col("n_s").alias("n_treated"), F.col("c_s").alias("c_treated"),
        F.col("n_n").alias("n_control"), F.col("c_n").alias("c_control"),
    )


@query("p06_legacy_reactivity", f"""WITH {V.COV}, {V.RC}, {V.COND},
m AS (SELECT c.d, c.p, c.t, c.c, coalesce(sum(n) FILTER (k <> 'ins'), 0) AS m
      FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL)
SELECT s.d AS design_idx, s.p AS pos, cond_idx,
  round(s.m / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE n.m / n.c END, 9) + 0.0 AS r,
  round(sqrt((s.m + 1) / (s.c * s.c) + CASE WHEN cond.n IS NULL THEN 0 ELSE
    (n.m + 1) / (n.c * n.c) + 0.25 * (n.m / n.c) * (n.m / n.c) END), 9) AS r_err,
  round(CASE WHEN cond.n IS NULL THEN 0 ELSE n.m / n.c END, 9) AS r_nomod
FROM cond JOIN m s ON s.t = cond.s LEFT JOIN m n ON n.t = cond.n AND n.d = s.d AND n.p = s.p""")
def legacy(spark, sf):
    out = R.legacy_reactivity(R.with_muts(V.counts(spark, sf)), V.CONDITIONS, control_error_scale=0.5,
                              tasks=V.count_tasks(spark, sf))
    return V.rounded(out, "r", "r_err", "r_nomod")


@query("p07_condition_label", f"WITH {V.COND} SELECT DISTINCT cond_idx, l_returnflag AS condition FROM lineitem JOIN cond ON l_returnflag = s")
def condition_label(spark, sf):
    tags = V.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("tag")).distinct()
    return R.condition_labels(tags, V.CONDITIONS)


_INNER = "(SELECT * FROM react WHERE p > 1 AND p <= 6)"
_TRIMMED = V.SN.format(rows=_INNER).replace(f"SELECT DISTINCT d, cond_idx FROM {_INNER}", "SELECT DISTINCT d, cond_idx FROM react")


@query("w04_first_last_trim", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT}, {_TRIMMED}
SELECT d AS design_idx, cond_idx, round(signal_to_noise, 9) + 0.0 AS signal_to_noise FROM sn""")
def signal_inside_ends(spark, sf):
    """Of the points inside the blanked ends, the first and last are left out once more."""
    out = signal_to_noise(_react(spark, sf).withColumn("seq_len", F.lit(7)), None, 1, 1)
    return V.rounded(out, "signal_to_noise")


# Runs and spread deletions -------------------------------------------------------------------------

@query("w01_homopolymer_runs", f"""WITH {V.LIB},
c AS (SELECT design_idx, unnest(generate_series(1, length(sequence))) AS p, sequence FROM lib WHERE sequence <> ''),
b AS (SELECT design_idx, p, substr(sequence, p, 1) AS b FROM c),
g AS (SELECT *, sum(chg) OVER (PARTITION BY design_idx ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN b = lag(b) OVER (PARTITION BY design_idx ORDER BY p) THEN 0 ELSE 1 END AS chg FROM b))
SELECT design_idx, min(b) AS base, CAST(min(p) AS INT) AS run_start, CAST(max(p) AS INT) AS run_end,
  CAST(count(*) AS INT) AS run_len FROM g GROUP BY design_idx, g""")
def runs(spark, sf):
    return S.homopolymer_runs(V.documents(spark, sf))


_DOC_PROFILE = """c AS (SELECT design_idx, unnest(generate_series(1, length(sequence))) AS p, sequence FROM lib WHERE sequence <> ''),
b AS (SELECT design_idx, p, substr(sequence, p, 1) AS b FROM c),
g AS (SELECT *, sum(chg) OVER (PARTITION BY design_idx ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN b = lag(b) OVER (PARTITION BY design_idx ORDER BY p) THEN 0 ELSE 1 END AS chg FROM b)),
prof AS (SELECT *, ((design_idx * 7 + p * 13) % 4 - 1) / 10.0 AS st, ((design_idx * 3 + p * 5) % 7) / 100.0 AS se,
  ((design_idx * 31 + p * 17) % 5) / 10.0 AS de, ((design_idx * 11 + p * 19) % 6) / 100.0 AS dee FROM g),
x AS (SELECT *, row_number() OVER (PARTITION BY design_idx, g ORDER BY p DESC) AS rn,
  count(*) OVER (PARTITION BY design_idx, g) AS n,
  sum(greatest(st, 0)) OVER (PARTITION BY design_idx, g) AS sw FROM prof),
y AS (SELECT *, max(CASE WHEN rn = 1 THEN de END) OVER (PARTITION BY design_idx, g) AS db,
  max(CASE WHEN rn = 1 THEN dee END) OVER (PARTITION BY design_idx, g) AS eb,
  CASE WHEN sw > 0 THEN greatest(st, 0) / sw ELSE 1.0 / n END AS wt FROM x),
z AS (SELECT *, CASE WHEN sw > 0 THEN se * (1 - wt) / sw ELSE 0 END AS we FROM y)"""


@query("w02_spread_deletions", f"""WITH {V.LIB}, {_DOC_PROFILE}
SELECT design_idx, CAST(p AS INT) AS pos, round(CASE WHEN rn = 1 THEN 0 ELSE de END + db * wt, 9) AS del,
  round(sqrt(CASE WHEN rn = 1 THEN 0 ELSE dee * dee END + eb * wt * eb * wt + db * we * db * we), 9) AS del_err
FROM z""")
def spread(spark, sf):
    d, p = F.col("design_idx"), F.col("pos")
    rows = S.library_positions(V.documents(spark, sf)).select(
        "*", F.lit(1).alias("cond_idx"),
        (((d * 7 + p * 13) % 4 - 1) / 10.0).alias("strict"), (((d * 3 + p * 5) % 7) / 100.0).alias("strict_err"),
        (((d * 31 + p * 17) % 5) / 10.0).alias("del"), (((d * 11 + p * 19) % 6) / 100.0).alias("del_err"),
    )
    out = S.spread_deletions(rows).select("design_idx", "pos", "del", "del_err")
    return V.rounded(out, "del", "del_err")


_FULL_OUT = """SELECT d AS design_idx, CAST(p AS INT) AS pos, b AS base, cond_idx, round(r, 9) + 0.0 AS r,
  round(re, 9) AS r_err, round(nomod, 9) AS r_nomod FROM full_r"""


@query("w02_reactivity_spread", f"WITH {V.FULL} {_FULL_OUT}")
def reactivity_spread(spark, sf):
    out = A.reactivity(V.counts(spark, sf), V.part_library(spark, sf), V.CONDITIONS).drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


@query("w03_spread_off", f"""WITH {V.FULL}
SELECT d AS design_idx, CAST(p AS INT) AS pos, b AS base, cond_idx, round(st + de, 9) + 0.0 AS r,
  round(sqrt(se * se + dee * dee + fl * fl), 9) AS r_err, round(nomod, 9) AS r_nomod FROM grid""")
def reactivity_unspread(spark, sf):
    out = A.reactivity(V.counts(spark, sf), V.part_library(spark, sf), V.CONDITIONS,
                       ReactivityOptions(spread_deletions=False)).drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


@query("f16_restrict_base", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.PARTS},
pos AS (SELECT design_idx AS d, p, substr(sequence, p, 1) AS b FROM parts, (SELECT unnest(generate_series(1, 7)) AS p)),
ga AS (SELECT c.d, c.p, c.t, c.c, coalesce(sum(n) FILTER (k = 'GA'), 0) AS st
  FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL)
SELECT pos.d AS design_idx, CAST(pos.p AS INT) AS pos, b AS base, cond.cond_idx,
  round(CASE WHEN b = 'G' THEN s.st / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE n.st / n.c END END, 9) + 0.0 AS r
FROM pos CROSS JOIN cond LEFT JOIN ga s ON s.t = cond.s AND s.d = pos.d AND s.p = pos.p
LEFT JOIN ga n ON n.t = cond.n AND n.d = s.d AND n.p = s.p""")
def only_at_base(spark, sf):
    out = A.reactivity(V.counts(spark, sf), V.part_library(spark, sf), V.CONDITIONS,
                       ReactivityOptions(only_GA=True, spread_deletions=False))
    return V.rounded(out.select("design_idx", "pos", "base", "cond_idx", "r"), "r")


_TRACK_CASE = """sum(n) FILTER (k IN ('CA','GA','TA')) AS a, sum(n) FILTER (k IN ('AC','GC','TC')) AS cc,
  sum(n) FILTER (k IN ('AG','CG','TG')) AS g, sum(n) FILTER (k IN ('AT','CT','GT')) AS u, sum(n) FILTER (k = 'ins') AS i"""


@query("p04_separate_tracks", f"""WITH {V.FULL},
tr AS (SELECT c.d, c.p, c.t, c.c, {_TRACK_CASE}
  FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL)
SELECT x.d AS design_idx, CAST(x.p AS INT) AS pos, x.cond_idx,
  {", ".join(f"round(coalesce(s.{c}, 0) / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE coalesce(n.{c}, 0) / n.c END, 9) + 0.0 AS {o}"
             for c, o in (("a", "to_A"), ("cc", "to_C"), ("g", "to_G"), ("u", "to_T"), ("i", "ins")))},
  round(x.d2, 9) + 0.0 AS del
FROM spread x JOIN cond USING (cond_idx)
LEFT JOIN tr s ON s.d = x.d AND s.p = x.p AND s.t = cond.s
LEFT JOIN tr n ON n.d = s.d AND n.p = s.p AND n.t = cond.n""")
def tracks(spark, sf):
    out = A.reactivity(V.counts(spark, sf), V.part_library(spark, sf), V.CONDITIONS,
                       ReactivityOptions(separate_tracks=True))
    cols = ["to_A", "to_C", "to_G", "to_T", "ins", "del"]
    return V.rounded(out.select("design_idx", "pos", "cond_idx", *cols), *cols)


# Normalization -------------------------------------------------------------------------------------

_NORM_SQL = ", ".join([V.FULL, V.COVMAX, V.TOTALS, V.NORMSET])


@query("f05_coverage_cascade", f"""WITH {V.COV}, {V.COVMAX}, {V.TOTALS}, {V.NORMSET}
SELECT d AS design_idx, total_coverage FROM pass""")
def cascade(spark, sf):
    return N.passing_designs(N.total_coverage(N.coverage_by_tag(V.counts(spark, sf))))


@query("w05_stride_sample", f"""WITH {V.COV}, {V.COVMAX}, {V.TOTALS}, {V.NORMSET}, {V.STRIDED}
SELECT d AS design_idx, total_coverage FROM strided""")
def stride_sample(spark, sf):
    return N.normalization_set(N.total_coverage(N.coverage_by_tag(V.counts(spark, sf))), NORM_MAX_SEQUENCES)


@query("f14_blank_ends", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT}
SELECT d AS design_idx, p AS pos, cond_idx, CASE WHEN p > 2 AND p <= 6 THEN round(r, 9) + 0.0 END AS r,
  round(re, 9) AS r_err FROM react""")
def blank(spark, sf):
    out = N.blank_ends(_react(spark, sf).withColumn("seq_len", F.lit(7)), 2, 1, ["r"])
    return V.rounded(out.select("design_idx", "pos", "cond_idx", "r", "r_err"), "r", "r_err")


_ENDS5 = " ".join(f"WHEN length(s) > {n} AND starts_with(s, '{end}') THEN {n}" for end, n in FIVE_PRIME_ENDS)
_ENDS3 = " ".join(f"WHEN length(s) > {n} AND ends_with(s, '{end}') THEN {n}" for end, n in THREE_PRIME_ENDS)


@query("f15_auto_blank_ends", f"""WITH {V.LIB} SELECT design_idx, CASE {_ENDS5} ELSE 0 END AS blank5, CASE {_ENDS3} ELSE 0 END AS blank3
FROM (SELECT design_idx, CASE design_idx % 3 WHEN 0 THEN '{FIVE_PRIME_ENDS[0][0]}' WHEN 1 THEN '{FIVE_PRIME_ENDS[1][0]}' ELSE '' END
       || sequence || CASE design_idx % 2 WHEN 0 THEN '{THREE_PRIME_ENDS[0][0]}' ELSE '' END AS s FROM lib)""")
def auto_blank(spark, sf):
    i = F.col("design_idx")
    flanked = V.documents(spark, sf).select("design_idx", F.concat(
        F.when(i % 3 == 0, FIVE_PRIME_ENDS[0][0]).when(i % 3 == 1, FIVE_PRIME_ENDS[1][0].replace("U", "T")).otherwise(""),
        "sequence", F.when(i % 2 == 0, THREE_PRIME_ENDS[0][0]).otherwise(""),
    ).alias("s"))
    b5, b3 = N.auto_blank_ends(F.col("s"))
    return flanked.select("design_idx", b5.alias("blank5"), b3.alias("blank3"))


_PER_TAG = f"""WITH {V.COV}, {V.RC}, f AS (
  SELECT c.d, c.p, c.t, coalesce(sum(n) FILTER (k <> 'ins'), 0) / c.c AS f
  FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY c.d, c.p, c.t, c.c)"""


@query("a11_percentile90_nearest_rank",
       f"{_PER_TAG}, {V.norm_values_sql('f', 't', 'f')} SELECT t AS tag, round(norm_val, 9) AS norm_val FROM nv")
def percentile90(spark, sf):
    f = R.mutation_fraction(V.counts(spark, sf)).select("tag", "f")
    return V.rounded(nearest_rank(f, ["tag"], "f", "norm_val"), "norm_val")


@query("o02_sort_for_rank",
       f"""{_PER_TAG}, {V.norm_values_sql('f', 'p', 'f')} SELECT p AS pos, round(norm_val, 9) AS norm_val FROM nv""")
def percentile90_by_position(spark, sf):
    f = R.mutation_fraction(V.counts(spark, sf)).select("pos", "f")
    return V.rounded(nearest_rank(f, ["pos"], "f", "norm_val"), "norm_val")


_BLANKED = "blanked AS (SELECT d, p, b, cond_idx, CASE WHEN p > 1 AND p <= 6 THEN r END AS r, re, nomod FROM full_r)"
_NV = "innorm AS (SELECT * FROM blanked SEMI JOIN normset USING (d)), " + V.norm_values_sql("innorm")


def _analysis(spark, sf, **options):
    return A.analyse(written(V.counts(spark, sf), "counts"), V.part_library(spark, sf), V.CONDITIONS,
                     ReactivityOptions(**options), blank5=1, blank3=1)


_NORMED = f"""WITH {_NORM_SQL}, {_BLANKED}, {_NV} SELECT d AS design_idx, CAST(p AS INT) AS pos, b AS base, cond_idx,
  round(r / norm_val, 9) + 0.0 AS r, round(re / norm_val, 9) AS r_err, round(nomod / norm_val, 9) AS r_nomod
FROM blanked LEFT JOIN nv USING (cond_idx)"""


@query("a12_normalize", _NORMED)
def normalized(spark, sf):
    out = _analysis(spark, sf).reactivity.drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


query("entry_normalized_reactivity", _NORMED)(normalized)


@query("a12_norm_values", f"WITH {_NORM_SQL}, {_BLANKED}, {_NV} SELECT cond_idx, round(norm_val, 9) AS norm_val FROM nv")
def norm_vals(spark, sf):
    return V.rounded(_analysis(spark, sf).norm_val, "norm_val")


_NVB = "innorm AS (SELECT * FROM blanked SEMI JOIN normset USING (d)), " + V.norm_values_sql("innorm", "cond_idx, b")


@query("a14_normalize_by_nt", f"""WITH {_NORM_SQL}, {_BLANKED}, {_NVB}
SELECT d AS design_idx, CAST(p AS INT) AS pos, cond_idx, b AS base, round(r / nullif(norm_val, 0), 9) + 0.0 AS r,
  round(re / nullif(norm_val, 0), 9) AS r_err FROM full_r LEFT JOIN nv USING (cond_idx, b)""")
def normalized_by_nt(spark, sf):
    counts, lib = written(V.counts(spark, sf), "counts"), A.with_length(V.part_library(spark, sf))
    out = A.normalize_by_nucleotide(counts, lib, V.CONDITIONS, blank5=1, blank3=1)
    return V.rounded(out.select("design_idx", "pos", "cond_idx", "base", "r", "r_err"), "r", "r_err")
