"""Queries over reshaping, sinks, streaming and alignment."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import joins as J
from ..functions import text as X
from ..operators.align import align_pairs, align_reads
from ..plans import analysis as A
from ..session import fresh_path, written
from ..sinks import bundle as B
from ..sinks import tables as T
from ..sinks import text as W
from ..sources import counts as C
from ..streaming import merge as S
from . import views as V
from .core import _BLANKED, _NORM_SQL, _NORMED, _NV
from .reads import _ALN, _alignments
from .registry import query
from .sets import _COUNTS_SQL, _QUALITY, _analysis


@query("p01_dense_to_long", f"""WITH {V.COV} SELECT d AS design_idx, t AS tag,
  array_to_string(list_transform(range(1, 8), lambda i: coalesce(list_extract(map_extract(map_from_entries(list((p, c))), CAST(i AS INT)), 1), 0)), ',') AS cells
FROM cov GROUP BY ALL""".replace("list((p, c))", "list(ROW(p, c))"))
def dense(spark, sf):
    c = V.counts(spark, sf).where("measure = 'coverage'")
    arrays = J.to_arrays(c, ["design_idx", "tag"], "n", 7)
    return arrays.select("design_idx", "tag", F.array_join(F.transform("n", lambda x: x.cast("string")), ",").alias("cells"))


@query("p01_long_to_dense_to_long", f"SELECT design_idx, pos, tag, measure, n FROM ({_COUNTS_SQL.format(where='')})")
def round_trip(spark, sf):
    arrays = J.to_arrays(V.counts(spark, sf), ["design_idx", "tag", "measure"], "n", 7)
    return J.to_long(arrays, ["design_idx", "tag", "measure"], "n").select("design_idx", "pos", "tag", "measure", "n")


_WIDE = ", ".join(f"coalesce(max(c) FILTER (p = {i}), 0) AS coverage_{i:04d}" for i in range(1, 8))


@query("p02_position_columns", f"WITH {V.COV} SELECT d AS design_idx, t AS tag, {_WIDE} FROM cov GROUP BY ALL")
def position_columns(spark, sf):
    c = V.counts(spark, sf).where("measure = 'coverage'")
    return J.position_columns(J.to_arrays(c, ["design_idx", "tag"], "n", 7), ["design_idx", "tag"], "n", 7, "coverage")


_TAG_COLS = ", ".join(f'CAST(coalesce(sum(coverage) FILTER (t = \'{t}\'), 0) AS BIGINT) AS "{t}"' for t in "ANR")


@query("p03_pivot_tags", f"WITH {V.COV}, {V.COVMAX} SELECT d AS design_idx, {_TAG_COLS} FROM covmax GROUP BY d")
def pivot_tags(spark, sf):
    from ..operators.normalize import coverage_by_tag
    return J.key_columns(coverage_by_tag(V.counts(spark, sf)), ["design_idx"], "tag", list("ANR"), "coverage")


@query("p11_rename_tags", """SELECT l_partkey + 1 AS design_idx, CASE l_returnflag WHEN 'A' THEN 'treated' WHEN 'N' THEN 'control' ELSE 'other' END AS tag,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY ALL""")
def rename_tags(spark, sf):
    names = spark.createDataFrame([("A", "treated"), ("N", "control"), ("R", "other")], "tag string, name string")
    c = V.counts(spark, sf).where("measure = 'coverage'").join(F.broadcast(names), "tag")
    return c.groupBy("design_idx", F.col("name").alias("tag")).agg(F.sum("n").alias("n"))


@query("a02_merge_counts_stream", _COUNTS_SQL.format(where=""))
def merge_stream(spark, sf):
    """Counts of four splits land one after another and are merged as a stream."""
    landing, out, state = (fresh_path(spark, n) for n in ("landing", "totals", "state"))
    c = V.counts(spark, sf, split=True).select("design_idx", "pos", "tag", "measure", "n", "split")
    for i in range(4):
        c.where(F.col("split") == i).drop("split").write.mode("append").parquet(landing)
        S.run_merge(spark, landing, out, state).awaitTermination()
    return S.latest_totals(spark, out)


@query("k01_counts_text", f"SELECT * FROM ({_COUNTS_SQL.format(where='')})")
def counts_text(spark, sf):
    path = fresh_path(spark, "counts")
    W.write_counts(V.counts(spark, sf), V.part_library(spark, sf), 7, path, sep=" ", compression="none")
    return C.read_counts_text(spark, f"{path}/*/*")


@query("k03_sublibrary_folders", f"""SELECT p_brand AS sublibrary, tag, measure, count(*) AS cells, CAST(sum(n) AS BIGINT) AS n
FROM ({_COUNTS_SQL.format(where='')}) JOIN part ON p_partkey + 1 = design_idx GROUP BY ALL""")
def sublibrary_folders(spark, sf):
    path = fresh_path(spark, "sublibraries")
    lib = V.part_library(spark, sf).select("design_idx", F.col("p_brand").alias("sublibrary"))
    V.counts(spark, sf).join(lib, "design_idx").write.partitionBy("sublibrary").parquet(path)
    return spark.read.parquet(path).groupBy("sublibrary", "tag", "measure").agg(
        F.count("*").alias("cells"), F.sum("n").alias("n"))


@query("k04_write_fasta", f"WITH {V.LIB} SELECT '>' || header AS first, replace(sequence, 'U', 'T') AS second FROM lib")
def write_fasta(spark, sf):
    path = fresh_path(spark, "dna")
    W.write_fasta(V.documents(spark, sf), path, sequence=F.translate("sequence", "U", "T"))
    text = spark.read.option("lineSep", "\n>").text(path)
    both = F.split(F.regexp_replace(F.regexp_replace("value", "^>", ""), "\n$", ""), "\n")
    return text.select(F.concat(F.lit(">"), both[0]).alias("first"), F.coalesce(F.get(both, F.lit(1)), F.lit("")).alias("second"))


_LABELS = f"""WITH {_QUALITY}, nr AS (
  SELECT d, p, r / norm_val AS r, CASE WHEN p > 1 AND p <= 6 THEN re / norm_val END AS re
  FROM blanked LEFT JOIN nv USING (cond_idx) WHERE cond_idx = 1)
SELECT CAST(q.d - 1 AS VARCHAR) AS id, sequence, q.reads, CASE WHEN q.signal_to_noise >= 1 AND q.reads >= 100 THEN 1 ELSE 0 END AS "SN_filter",
  {", ".join(f"round(max(r) FILTER (p = {i}), 9) + 0.0 AS v{i}, round(max(re) FILTER (p = {i}), 9) AS e{i}" for i in range(1, 8))}
FROM quality q JOIN parts ON parts.design_idx = q.d JOIN nr ON nr.d = q.d WHERE q.cond_idx = 1 GROUP BY ALL"""


@query("k06_labels_values", _LABELS)
def labels_values(spark, sf):
    """The label table's numbers before they become text with three decimals."""
    from ..operators.normalize import blank_ends
    a = _analysis(spark, sf)
    head = T.labels_table(a, 1, 7, "X", "x").select("design_idx", "id", "sequence", "reads", "SN_filter")
    blanked = replace(a, reactivity=blank_ends(a.reactivity, a.blank5, a.blank3, ["r_err"]))
    values = T.value_arrays(blanked, 1, 7)
    wide = J.position_columns(values, ["design_idx"], "r", 7, "v").join(J.position_columns(values, ["design_idx"], "r_err", 7, "e"), "design_idx")
    wide = wide.withColumnsRenamed({f"{x}_{i:04d}": f"{x}{i}" for x in "ve" for i in range(1, 8)})
    out = head.join(wide, "design_idx").drop("design_idx")
    return V.rounded(out, *[f"{x}{i}" for x in "ve" for i in range(1, 8)])


@query("k06_labels_csv")
def labels_csv(spark, sf):
    path = fresh_path(spark, "labels")
    T.write_csv(T.labels_table(_analysis(spark, sf), 1, 7, "2A3", "parts"), path)
    return spark.read.option("header", True).csv(path)


@query("k07_examples_csv", f"WITH {V.LIB} SELECT CAST(design_idx - 1 AS VARCHAR) AS id, sequence, translate(sequence, 'ACGU', '.().') AS mfe FROM lib WHERE sequence <> ''")
def examples_csv(spark, sf):
    lib = V.documents(spark, sf).where("sequence <> ''")
    mfe = lib.select("design_idx", F.translate("sequence", "ACGU", ".().").alias("mfe"))
    path = fresh_path(spark, "examples")
    T.write_csv(T.examples_table(lib, mfe), path)
    return spark.read.option("header", True).csv(path)


@query("k08_coverage_csv", f"""WITH {V.COV}, {V.COVMAX}, {V.PARTS} SELECT header, sequence, {_TAG_COLS}
FROM parts LEFT JOIN covmax ON d = design_idx GROUP BY design_idx, header, sequence""")
def coverage_csv(spark, sf):
    path = fresh_path(spark, "coverage")
    T.write_csv(T.coverage_table(_analysis(spark, sf)), path)
    return spark.read.schema("header string, sequence string, A bigint, N bigint, R bigint").option("header", True).csv(path)


@query("k08_reads_csv", f"""WITH {V.COV}, {V.COND}, {V.COVMAX}, {V.READS}, {V.PARTS} SELECT header, sequence,
  coalesce(max(reads) FILTER (cond_idx = 1), 0) AS "1_A", coalesce(max(reads) FILTER (cond_idx = 2), 0) AS "2_R",
  coalesce(max(reads) FILTER (cond_idx = 3), 0) AS "3_R"
FROM parts LEFT JOIN reads ON d = design_idx GROUP BY design_idx, header, sequence""")
def reads_csv(spark, sf):
    return T.reads_table(_analysis(spark, sf)).drop("design_idx")


@query("k05_entry_annotations", f"""WITH {_QUALITY} SELECT q.d AS design_idx,
  q.signal_to_noise >= 1 AND q.reads >= 100 AS good, 'sequence:' || sequence AS first,
  'reads:' || q.reads AS second, NOT (q.signal_to_noise >= 1 AND q.reads >= 100) AS flagged
FROM quality q JOIN parts ON parts.design_idx = q.d WHERE cond_idx = 2""")
def entry_annotations(spark, sf):
    e = T.entry_annotations(_analysis(spark, sf), 2, "lib")
    return e.select("design_idx", "good", F.col("annotations")[0].alias("first"), F.col("annotations")[1].alias("second"),
                    F.array_contains("annotations", "warning:badQuality").alias("flagged"))


@query("k05_entry_file")
def entry_file(spark, sf):
    a = B.settle(_analysis(spark, sf), ("reactivity", "norm_val", "signal_to_noise"))
    path = fresh_path(spark, "entries")
    T.write_entries(T.entry_lines(a, 1, 7, "lib", "parts"), path)
    return spark.read.text(path).select("chunk", "value")


@query("k09_bundle_round_trip", _NORMED)
def bundle_round_trip(spark, sf):
    a = _analysis(spark, sf)
    path = fresh_path(spark, "bundle")
    B.write_bundle(a, path, ("reactivity", "norm_val"))
    meta = B.read_metadata(spark, path)
    assert [c["treated"] for c in meta["conditions"]] == [c.treated for c in a.conditions]
    return V.rounded(B.read_table(spark, path, "reactivity").drop("seq_len"), "r", "r_err", "r_nomod")


@query("k11_norm_report", f"WITH {_NORM_SQL}, {_BLANKED}, {_NV} SELECT cond_idx, printf('%.4f', norm_val) AS norm_val FROM nv")
def norm_report(spark, sf):
    a = A.analyse(written(V.counts(spark, sf), "counts"), V.part_library(spark, sf), V.CONDITIONS, blank5=1, blank3=1)
    return a.norm_val.select("cond_idx", F.format_string("%.4f", "norm_val").alias("norm_val"))


_BUILT = "CASE kind WHEN 'tail' THEN 0 WHEN 'one' THEN -3 ELSE -6 END"


@query("j08_align_reads", f"""WITH {_ALN}
SELECT read_id, CAST({_BUILT} AS INT) AS built, true AS scored, true AS at_source FROM aln WHERE seq <> ''""")
def align(spark, sf):
    """Every read, by the default limit: scored as it was built or better, and, if one design alone fits it so, on its own."""
    built = F.when(F.col("kind") == "tail", 0).when(F.col("kind") == "one", -3).otherwise(-6)
    path = fresh_path(spark, "align")
    _alignments(spark, sf).where("seq <> ''").select(
        "read_id", F.lit("all").alias("tag"), "seq", "ref", "pos", "cigar", built.alias("built")).write.parquet(path)
    reads = spark.read.parquet(path)
    lib = V.documents(spark, sf).select("design_idx", (F.col("design_idx") - 1).cast("string").alias("name"), "sequence")
    best = align_reads(reads.select("read_id", "tag", "seq"), lib).select("read_id", "score", "mapq", F.col("ref").alias("on"))
    own = (F.col("score") > F.col("built")) | (F.col("mapq") == 0) | (F.col("on") == F.col("ref"))
    return reads.join(best, "read_id", "left").select(
        "read_id", "built", F.coalesce(F.col("score") >= F.col("built"), F.lit(False)).alias("scored"), F.coalesce(own, F.lit(False)).alias("at_source"))


@query("j08_align_pairs", f"""WITH {V.LIB}, dna AS (SELECT design_idx, replace(sequence, 'U', 'T') AS dna FROM lib WHERE sequence <> ''),
frags AS (SELECT design_idx, k, substr(dna, CAST(200 * k + 1 AS INT), 200) AS frag FROM (SELECT *, unnest(generate_series(0, (length(dna) - 1) // 200)) AS k FROM dna)),
mates AS (SELECT design_idx || '_' || k AS read_id, substr(frag, 1, 60) AS a, substr(frag, CAST(greatest(length(frag) - 59, 1) AS INT)) AS b FROM frags WHERE length(frag) >= 60),
kinds AS (SELECT DISTINCT a, b FROM mates),
hits AS (SELECT a, b, design_idx, dna, strpos(substr(dna, CAST(strpos(dna, a) AS INT), 800), b) AS n FROM kinds JOIN dna ON contains(dna, a) AND contains(dna, b)),
later AS (SELECT a, b, design_idx, unnest(generate_series(1, length(dna))) AS i, dna FROM hits WHERE n = 0),
ok AS (SELECT a, b, design_idx FROM hits WHERE n > 0 UNION ALL
  SELECT a, b, design_idx FROM later WHERE substr(dna, CAST(i AS INT), length(a)) = a AND strpos(substr(dna, CAST(i AS INT), 800), b) > 0),
fits AS (SELECT a, b, min(design_idx) AS first FROM ok GROUP BY a, b)
SELECT read_id, CAST(first - 1 AS VARCHAR) AS ref, CAST(0 AS BIGINT) AS score
FROM mates JOIN fits USING (a, b)""")
def align_mates(spark, sf):
    """Ends of fragments of 200 letters: each pair on the first design that has both.

    mapq is not compared: it is 0 for some pairs whose mates are ambiguous alone although one design has both (see align_pairs).
    """
    lib = V.documents(spark, sf).select("design_idx", (F.col("design_idx") - 1).cast("string").alias("name"), "sequence").where("sequence <> ''")
    frags = lib.select("design_idx", X.to_dna(F.col("sequence")).alias("dna"), F.explode(
        F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / 200).cast("int"))).alias("k")).select(
        F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"),
        F.substring("dna", F.col("k") * 200 + 1, F.lit(200)).alias("frag")).where(F.length("frag") >= 60)
    path = fresh_path(spark, "mates")
    frags.select("read_id", F.lit("all").alias("tag"), F.substring("frag", 1, 60).alias("seq"),
                 F.substring("frag", F.length("frag") - 59, F.lit(60)).alias("mate_seq")).write.parquet(path)
    placed = align_pairs(spark.read.parquet(path), lib).where(F.col("flag").bitwiseAND(2) != 0)
    return placed.groupBy("read_id").agg(F.max("ref").alias("ref"), F.sum("score").alias("score"))
