"""Queries through the whole analysis: recognised ends, totals only, merged rates, chosen cutoff, and stored forms."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import __version__
from ..fixed_values import FIVE_PRIME_ENDS, THREE_PRIME_ENDS
from ..operators import algebra as G
from ..operators import reactivity as R
from ..options import ReactivityOptions
from ..plans import analysis as A
from ..session import fresh_path, written
from ..sinks import bundle as B
from ..sinks import tables as T
from . import views as V
from .core import _BLANKED, _NORM_SQL, _NV
from .registry import query
from .sets import _COUNTS_SQL

TAGS = ["A", "N", "R"]
_FIVE, _N5 = FIVE_PRIME_ENDS[0]
_THREE, _N3 = THREE_PRIME_ENDS[0]


@query("f15_analyse_recognised_ends", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT},
{V.COVMAX}, {V.TOTALS}, {V.NORMSET},
innorm AS (SELECT * FROM react SEMI JOIN normset USING (d)), {V.norm_values_sql("innorm")},
places AS (SELECT p_partkey + 1 AS d, x - {_N5} AS p, cond_idx
  FROM part, (SELECT unnest(generate_series(1, {_N5 + 7 + _N3})) AS x), cond)
SELECT d AS design_idx, CAST(p + {_N5} AS INT) AS pos, cond_idx, round(r / norm_val, 9) + 0.0 AS r,
  round(re / norm_val, 9) AS r_err, round(nomod / norm_val, 9) AS r_nomod, {_N5} AS blank5, {_N3} AS blank3
FROM places LEFT JOIN react USING (d, p, cond_idx) LEFT JOIN nv USING (cond_idx)""")
def recognised_ends(spark, sf):
    """Designs between the constant ends; their lengths are left to the analysis."""
    counts = written(V.counts(spark, sf).withColumn("pos", F.col("pos") + _N5), "counts")
    library = V.part_library(spark, sf).withColumn("sequence", F.concat(F.lit(_FIVE), "sequence", F.lit(_THREE)))
    a = A.analyse(counts, library, V.CONDITIONS, ReactivityOptions(spread_deletions=False), None, None, tags=TAGS)
    out = a.reactivity.drop("seq_len", "base").withColumns({"blank5": F.lit(a.blank5), "blank3": F.lit(a.blank3)})
    return V.rounded(out, "r", "r_err", "r_nomod")


@query("p06_analyse_totals_only", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.COVMAX}, {V.TOTALS}, {V.NORMSET},
m AS (SELECT c.d, c.p, c.t, c.c, coalesce(sum(n) FILTER (k <> 'ins'), 0) AS m
      FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL),
react AS (SELECT s.d, s.p, cond_idx, s.m / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE n.m / n.c END AS r,
    sqrt((s.m + 1) / (s.c * s.c) + CASE WHEN cond.n IS NULL THEN 0 ELSE (n.m + 1) / (n.c * n.c) END) AS re,
    CASE WHEN cond.n IS NULL THEN 0 ELSE n.m / n.c END AS nomod
  FROM cond JOIN m s ON s.t = cond.s LEFT JOIN m n ON n.t = cond.n AND n.d = s.d AND n.p = s.p),
places AS (SELECT p_partkey + 1 AS d, p, cond_idx FROM part, (SELECT unnest(generate_series(1, 7)) AS p), cond),
blanked AS (SELECT d, p, cond_idx, CASE WHEN p > 1 AND p <= 6 THEN r END AS r, re, nomod
  FROM places LEFT JOIN react USING (d, p, cond_idx)),
{_NV}
SELECT d AS design_idx, CAST(p AS INT) AS pos, cond_idx, round(r / norm_val, 9) + 0.0 AS r,
  round(re / norm_val, 9) AS r_err, round(nomod / norm_val, 9) AS r_nomod FROM blanked LEFT JOIN nv USING (cond_idx)""")
def totals_only(spark, sf):
    counts = written(R.with_muts(V.counts(spark, sf)), "counts")
    a = A.analyse(counts, V.part_library(spark, sf), V.CONDITIONS, ReactivityOptions(totals_only=True), 1, 1, tags=TAGS)
    return V.rounded(a.reactivity.drop("seq_len", "base"), "r", "r_err", "r_nomod")


@query("f05_analyse_cutoff", f"WITH {V.COV}, {V.COVMAX}, {V.TOTALS}, {V.NORMSET} SELECT CAST(cutoff AS INT) AS cutoff FROM cut")
def chosen_cutoff(spark, sf):
    a = A.analyse(V.counts(spark, sf), V.part_library(spark, sf), V.CONDITIONS, ReactivityOptions(normalize=False))
    return a.norm_cutoff


@query("u03_merged_rates", f"""WITH {V.COV}, {V.RC},
merged AS (SELECT * FROM (VALUES ('A', 'A_R'), ('R', 'A_R'), ('N', 'N_N'), ('N', 'N_N')) AS v(t, tag)),
c AS (SELECT p, tag, CAST(sum(c) AS BIGINT) AS c FROM cov JOIN merged USING (t) GROUP BY ALL),
k AS (SELECT p, tag, k, CAST(sum(n) AS BIGINT) AS n FROM rc JOIN merged USING (t) GROUP BY ALL)
SELECT c.p AS pos, c.tag, m.k AS measure, round(coalesce(n, 0) / c, 9) AS rate, c AS coverage
FROM c CROSS JOIN (SELECT unnest({V._TYPE_LIST}) AS k) m LEFT JOIN k ON k.p = c.p AND k.tag = c.tag AND k.k = m.k""")
def merged_rates(spark, sf):
    """Rates of merged conditions; a control that two of them share counts twice, as its coverage does."""
    a = A.analyse(written(V.counts(spark, sf), "counts"), V.part_library(spark, sf), V.CONDITIONS,
                  ReactivityOptions(normalize=False), 1, 1)
    return V.rounded(G.merge_conditions(a, [[1, 2]]).rates, "rate")


@query("u01_concat_rates", f"""WITH {V.COV}, {V.RC},
c AS (SELECT p, t, CAST(sum(c) AS BIGINT) AS c FROM cov GROUP BY ALL),
k AS (SELECT p, t, k, CAST(sum(n) AS BIGINT) AS n FROM rc GROUP BY ALL)
SELECT c.p AS pos, c.t AS tag, m.k AS measure, round(coalesce(n, 0) / c, 9) AS rate, c AS coverage
FROM c CROSS JOIN (SELECT unnest({V._TYPE_LIST}) AS k) m LEFT JOIN k ON k.p = c.p AND k.t = c.t AND k.k = m.k""")
def concatenated_rates(spark, sf):
    """Rates of two data sets of different designs, stacked."""
    counts, lib = written(V.counts(spark, sf), "counts"), V.part_library(spark, sf)
    sets = []
    for second in (False, True):
        own = F.col("design_idx") % 2 == int(second)
        one = A.analyse(counts.where(own), lib.where(own), V.CONDITIONS, ReactivityOptions(normalize=False), tags=TAGS)
        sets.append((one, 0))
    return V.rounded(G.concat_designs(sets).rates, "rate")


@query("k02_counts_table", _COUNTS_SQL.format(where=""))
def counts_table(spark, sf):
    path = fresh_path(spark, "counts-table")
    T.write_counts_table(V.counts(spark, sf), path)
    return T.read_counts_table(spark, path)


@query("k12_version_tag", f"""WITH {_NORM_SQL}, {_BLANKED}, {_NV}
SELECT cond_idx, round(norm_val, 9) AS norm_val, '{__version__}' AS version FROM nv""")
def version_tag(spark, sf):
    """Stored norm values with the version that the stored data set says made them."""
    a = A.analyse(written(V.counts(spark, sf), "counts"), V.part_library(spark, sf), V.CONDITIONS, blank5=1, blank3=1)
    path = fresh_path(spark, "bundle")
    B.write_bundle(replace(a, tags=TAGS), path, ("norm_val",))
    stored = B.read_table(spark, path, "norm_val")
    return V.rounded(stored, "norm_val").withColumn("version", F.lit(B.read_metadata(spark, path)["version"]))
