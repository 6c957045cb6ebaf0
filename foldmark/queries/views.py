"""The given tables seen as libraries, counts, reads and logs.

Each view exists twice: as a DataFrame, and as the SQL text of a common table
expression the oracle queries share. Every view covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MUT_TYPES
from ..options import conditions_for
from ..session import tasks_for

DIGITS = 9

# Treated/control experiments over the tags A, N, R.
CONDITIONS = conditions_for([("A", "N"), ("R", "N"), ("R",)])
BARCODES = (("BC1", "CTA"), ("BC2", "GAC"), ("BC3", "ACG"), ("BC4", "TTT"))
STAGES = ("view", "click", "signup", "purchase", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round computed doubles, as the oracle does, so that sums in another order agree.

    The oracle rounds the product with the power of ten, a double itself, not
    the decimal digits; the two differ just below a half. Adding zero turns a
    negative zero into zero.
    """
    scale = F.lit(10.0**digits)
    return df.withColumns({c: F.round(F.col(c).cast("double") * scale) / scale + F.lit(0.0) for c in columns})


def text_sequence(text: str | Column) -> Column:
    """The nucleotide letters of a text, as RNA-neutral DNA letters T->U."""
    return F.translate(F.upper(F.regexp_replace(text, "[^ACGTUacgtu]", "")), "T", "U")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a design library; the sequence is the whole text's nucleotide letters."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        (F.col("doc_id") + 1).alias("design_idx"),
        F.concat_ws("\t", F.col("doc_id").cast("string"), "source", "lang").alias("header"),
        text_sequence("text").alias("sequence"),
        "source", "lang",
    )


LIB = r"""lib AS (
  SELECT doc_id + 1 AS design_idx, doc_id || chr(9) || source || chr(9) || lang AS header,
         replace(upper(regexp_replace(text, '[^ACGTUacgtu]', '', 'g')), 'T', 'U') AS sequence,
         source, lang
  FROM documents)"""


def part_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as designs of seven positions whose bases follow from key and size."""
    base = F.transform(
        F.sequence(F.lit(1), F.lit(7)),
        lambda i: F.substring(
            F.lit("ACGU"), ((F.floor(F.col("p_partkey") / i) + F.col("p_size")) % 4 + 1).cast("int"), F.lit(1)
        ),
    )
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("design_idx"),
        F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("header"),
        F.array_join(base, "").alias("sequence"),
        "p_brand",
    )


PARTS = """parts AS (
  SELECT p_partkey + 1 AS design_idx, p_partkey || chr(9) || p_name || chr(9) || p_brand AS header,
         array_to_string(list_transform(range(1, 8),
           lambda i: substr('ACGU', CAST((p_partkey // i + p_size) % 4 + 1 AS INT), 1)), '') AS sequence,
         p_brand
  FROM part)"""


def count_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the counts of all line items and for what pairs them; an item becomes two rows at most."""
    return tasks_for(spark, 2 * table(spark, sf_dir, "lineitem").count())


def counts(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """Line items as sparse counts: quantity is coverage, each row one mutation.

    Design = part, position = line number, tag = return flag, mutation type by
    supplier. Both measures come from one scan and one aggregation. Line items
    are dealt out by cell before they become counts: a file's share of them
    repeats few cells, so sums per file would hold nearly every row in memory.
    """
    li = table(spark, sf_dir, "lineitem")
    tasks = count_tasks(spark, sf_dir)
    kind = F.element_at(F.array(*[F.lit(t) for t in MUT_TYPES]), (F.col("l_suppkey") % 14 + 1).cast("int"))
    both = F.explode(F.array(
        F.struct(F.lit(COVERAGE).alias("measure"), F.col("l_quantity").cast("bigint").alias("n")),
        F.struct(kind.alias("measure"), F.lit(1).cast("bigint").alias("n")),
    ))
    keys = ["design_idx", "pos", "tag", "measure"] + (["split"] if split else [])
    return li.select(
        (F.col("l_partkey") + 1).alias("design_idx"), F.col("l_linenumber").alias("pos"),
        F.col("l_returnflag").alias("tag"), (F.col("l_orderkey") % 4).cast("int").alias("split"),
        "l_quantity", "l_suppkey",
    ).repartition(tasks, "design_idx", "pos", "tag").select(
        "design_idx", "pos", "tag", "split", both.alias("x")
    ).select("design_idx", "pos", "tag", "split", "x.*").groupBy(*keys).agg(F.sum("n").alias("n"))


_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in MUT_TYPES) + "]"

COV = """cov AS (
  SELECT l_partkey + 1 AS d, l_linenumber AS p, l_returnflag AS t,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS c
  FROM lineitem GROUP BY ALL)"""
RC = f"""rc AS (
  SELECT l_partkey + 1 AS d, l_linenumber AS p, l_returnflag AS t,
         {_TYPE_LIST}[CAST(l_suppkey % 14 + 1 AS INT)] AS k, count(*) AS n
  FROM lineitem GROUP BY ALL)"""
COND = """cond AS (
  SELECT * FROM (VALUES (1, 'A', 'N'), (2, 'R', 'N'), (3, 'R', NULL)) AS v(cond_idx, s, n))"""

# Profiles per tag, and background-subtracted per condition (no spreading).
_STRICT = "k NOT IN ('ins', 'del')"
TAGS = f"""tags AS (
  SELECT c.d, c.p, c.t, c.c,
         coalesce(sum(n) FILTER ({_STRICT}), 0) AS st, coalesce(sum(n) FILTER (k = 'del'), 0) AS de,
         coalesce(sum(n) FILTER (k = 'ins'), 0) AS ins
  FROM cov c LEFT JOIN rc ON rc.d = c.d AND rc.p = c.p AND rc.t = c.t GROUP BY ALL)"""
SUB = """sub AS (
  SELECT s.d, s.p, cond.cond_idx,
         s.st / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE n.st / n.c END AS st,
         sqrt(s.st / (s.c * s.c) + CASE WHEN cond.n IS NULL THEN 0 ELSE n.st / (n.c * n.c) END) AS se,
         s.de / s.c - CASE WHEN cond.n IS NULL THEN 0 ELSE n.de / n.c END AS de,
         sqrt(s.de / (s.c * s.c) + CASE WHEN cond.n IS NULL THEN 0 ELSE n.de / (n.c * n.c) END) AS dee,
         sqrt(1.0 / (s.c * s.c) + CASE WHEN cond.n IS NULL THEN 0 ELSE 1.0 / (n.c * n.c) END) AS fl,
         CASE WHEN cond.n IS NULL THEN 0 ELSE (n.st + n.de) / n.c END AS nomod
  FROM cond JOIN tags s ON s.t = cond.s LEFT JOIN tags n ON n.t = cond.n AND n.d = s.d AND n.p = s.p)"""
REACT = """react AS (
  SELECT d, p, cond_idx, st + de AS r, sqrt(se * se + dee * dee + fl * fl) AS re, nomod FROM sub)"""
# Runs of the seven-letter designs, and deletions spread over them.
RUNS = """pos AS (
  SELECT design_idx AS d, p, substr(sequence, p, 1) AS b
  FROM parts, (SELECT unnest(generate_series(1, 7)) AS p)),
runs AS (
  SELECT d, p, b, sum(chg) OVER (PARTITION BY d ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT d, p, b, CASE WHEN b = lag(b) OVER (PARTITION BY d ORDER BY p) THEN 0 ELSE 1 END AS chg FROM pos))"""
SPREAD = """grid AS (
  SELECT r.d, r.p, r.b, r.g, c.cond_idx, x.st, x.se, x.de, x.dee, x.fl, x.nomod,
         row_number() OVER (PARTITION BY r.d, c.cond_idx, r.g ORDER BY r.p DESC) AS rn,
         count(*) OVER (PARTITION BY r.d, c.cond_idx, r.g) AS n,
         sum(greatest(coalesce(x.st, 0), 0)) OVER (PARTITION BY r.d, c.cond_idx, r.g) AS sw
  FROM runs r CROSS JOIN cond c
  LEFT JOIN sub x ON x.d = r.d AND x.p = r.p AND x.cond_idx = c.cond_idx),
w AS (
  SELECT *, max(CASE WHEN rn = 1 THEN de END) OVER (PARTITION BY d, cond_idx, g) AS db,
         max(CASE WHEN rn = 1 THEN dee END) OVER (PARTITION BY d, cond_idx, g) AS eb,
         CASE WHEN sw > 0 THEN greatest(coalesce(st, 0), 0) / sw ELSE 1.0 / n END AS wt FROM grid),
w2 AS (SELECT *, CASE WHEN sw > 0 THEN se * (1 - wt) / sw ELSE 0 END AS we FROM w),
spread AS (
  SELECT d, p, b, cond_idx, st, se, fl, nomod,
         CASE WHEN rn = 1 THEN 0 ELSE de END + db * wt AS d2,
         sqrt(CASE WHEN rn = 1 THEN 0 ELSE dee * dee END + eb * wt * eb * wt + db * we * db * we) AS e2
  FROM w2),
full_r AS (
  SELECT d, p, b, cond_idx, st + d2 AS r, sqrt(se * se + e2 * e2 + fl * fl) AS re, nomod FROM spread)"""
FULL = ", ".join([COV, RC, COND, TAGS, SUB, PARTS, RUNS, SPREAD])

COVMAX = "covmax AS (SELECT d, t, max(c) AS coverage FROM cov GROUP BY ALL)"
TOTALS = "totals AS (SELECT d, CAST(sum(coverage) AS BIGINT) AS total_coverage FROM covmax GROUP BY ALL)"
NORMSET = """cut AS (
  SELECT CASE WHEN count(*) FILTER (total_coverage > 10000) >= 10 THEN 10000
              WHEN count(*) FILTER (total_coverage > 1000) >= 10 THEN 1000
              WHEN count(*) FILTER (total_coverage > 100) >= 10 THEN 100 ELSE -1 END AS cutoff FROM totals),
pass AS (
  SELECT d, total_coverage, row_number() OVER (ORDER BY d) AS k, count(*) OVER () AS n
  FROM totals, cut WHERE total_coverage > cutoff),
normset AS (
  SELECT d, total_coverage FROM pass)"""
STRIDED = """strided AS (
  SELECT d, total_coverage FROM pass WHERE k % (CASE WHEN n > 1000 THEN n // 1000 ELSE 1 END) = 0)"""


def norm_values_sql(rows: str, group: str = "cond_idx", value: str = "r", name: str = "nv") -> str:
    """CTE ``name``: nearest-rank 90th percentile of ``rows`` per group, non-zero values if it is 0."""
    return f"""{name} AS (
  SELECT {group}, CASE WHEN max(va) = 0 THEN coalesce(max(vz), 0) ELSE max(va) END AS norm_val FROM (
    SELECT {group},
      CASE WHEN k = (9 * n + 5) // 10 THEN v END AS va,
      CASE WHEN v <> 0 AND kz = (9 * nz + 5) // 10 THEN v END AS vz
    FROM (SELECT {group}, {value} AS v,
            row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS k,
            count(*) OVER (PARTITION BY {group}) AS n,
            CASE WHEN {value} <> 0 THEN row_number() OVER (PARTITION BY {group}, {value} <> 0 ORDER BY {value}) END AS kz,
            count(*) FILTER ({value} <> 0) OVER (PARTITION BY {group}) AS nz
          FROM {rows} WHERE {value} IS NOT NULL)) GROUP BY {group})"""


SN = """good AS (
  SELECT d, cond_idx, p, r, re, row_number() OVER (PARTITION BY d, cond_idx ORDER BY p) AS a,
         row_number() OVER (PARTITION BY d, cond_idx ORDER BY p DESC) AS z,
         count(*) OVER (PARTITION BY d, cond_idx) AS k
  FROM {rows} WHERE r IS NOT NULL AND re > 0),
sn0 AS (
  SELECT d, cond_idx, avg(r) / avg(re) AS v FROM good WHERE k > 3 AND a > 1 AND z > 1 GROUP BY ALL),
sn AS (
  SELECT x.d, x.cond_idx, coalesce(v, 0) AS signal_to_noise
  FROM (SELECT DISTINCT d, cond_idx FROM {rows}) x LEFT JOIN sn0 USING (d, cond_idx))"""
READS = """reads AS (
  SELECT d, cond_idx, CAST(sum(coverage) AS BIGINT) AS reads FROM (
    SELECT m.d, c.cond_idx, m.coverage FROM covmax m JOIN cond c ON m.t = c.s
    UNION ALL SELECT m.d, c.cond_idx, m.coverage FROM covmax m JOIN cond c ON m.t = c.n) GROUP BY ALL)"""
