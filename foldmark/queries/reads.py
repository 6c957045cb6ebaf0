"""Queries over sources, validation, strings, reads and read-level joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MUT_TYPES
from ..functions import text as X
from ..operators import joins as J
from ..operators import pairs as P
from ..operators import pileup as U
from ..operators import reactivity as R
from ..operators import reads as D
from ..operators import validate as K
from ..operators.index import build_index
from ..plans import analysis as A
from ..session import fresh_path, written
from ..sinks import text as W
from ..sinks.bundle import read_table, write_bundle
from ..sources import counts as C
from ..sources import fasta, fastq, tables
from . import views as V
from .core import _NORMED
from .registry import query
from .sets import _COUNTS_SQL

# Overlapping 60-letter stretches that cover every sequence, as DNA.
TILES = f"""{V.LIB}, tiles AS (
  SELECT design_idx, k, 40 * k + 1 AS start, replace(sequence, 'U', 'T') AS dna,
         replace(substr(sequence, 40 * k + 1, 60), 'U', 'T') AS seq
  FROM (SELECT *, unnest(generate_series(0, (length(sequence) - 1) // 40)) AS k FROM lib WHERE sequence <> ''))"""


def _tiles(spark, sf):
    # Dealt out while a design is one short row: each becomes many reads, and most of the work.
    # The number of tasks is stated, as the few bytes would be coalesced.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Letters are turned into DNA before that, and reads cut before they become rows, else each read's row does a whole design's work.
    lib = V.documents(spark, sf).where(F.length("sequence") > 0).select(
        "design_idx", X.to_dna(F.col("sequence")).alias("dna")).repartition(tasks, "design_idx")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("dna") - 1) / 40).cast("int")), lambda k: F.struct(
        k.alias("k"), (k * 40 + 1).alias("start"), F.substring("dna", k * 40 + 1, F.lit(60)).alias("seq")))
    return lib.select("design_idx", "dna", F.explode(cut).alias("x")).select("design_idx", "dna", "x.*")


_QUAL = "substr(repeat('IIIIIIIIIIIIIIIIIIIIIIII5II::III', 5), CAST(design_idx % 17 + 1 AS INT), length(seq))"


def _qual(seq="seq"):
    pattern = F.repeat(F.lit("IIIIIIIIIIIIIIIIIIIIIIII5II::III"), F.lit(5))
    return F.substring(pattern, (F.col("design_idx") % 17 + 1).cast("int"), F.length(seq))


# Sources -------------------------------------------------------------------------------------------

@query("s01_scan_fasta", f"WITH {V.LIB} SELECT design_idx, header, sequence FROM lib")
def scan_fasta(spark, sf):
    path = fresh_path(spark, "library")
    W.write_fasta(V.documents(spark, sf), path, blank_line=True)
    return fasta.read_fasta(spark, path).drop("file")


_INFO = """SELECT design_idx, sequence, CAST(design_idx - 1 AS VARCHAR) AS id_string,
  CAST(design_idx - 1 AS DOUBLE) AS id, source AS title, lang AS author FROM lib"""


@query("s02_scan_fasta_seqinfo", f"WITH {V.LIB} {_INFO.replace('source AS title, lang AS author', 'lang AS author, source AS title')}")
def seqinfo(spark, sf):
    return fasta.sequence_info(V.documents(spark, sf)).drop("header")


@query("s02_title_author_swap", f"WITH {V.LIB} {_INFO}")
def seqinfo_swapped(spark, sf):
    lib = V.documents(spark, sf)
    swapped = lib.withColumn("header", F.concat_ws("\t", (F.col("design_idx") - 1).cast("string"), "lang", "source"))
    return fasta.sequence_info(swapped).drop("header")


@query("s03_scan_barcodes", """SELECT s_suppkey + 1 AS tag_idx, replace(s_name, ' ', '_') AS tag,
  translate(lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), '0123456789', 'ACGTACGTAC') AS barcode FROM supplier""")
def scan_barcodes(spark, sf):
    s = V.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1).alias("design_idx"), F.translate("s_name", " ", "_").alias("header"),
        F.translate(F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), "0123456789", "ACGTACGTAC").alias("sequence"))
    path = fresh_path(spark, "barcodes")
    W.write_fasta(s, path)
    return fasta.read_barcodes(spark, path)


@query("s04_scan_fastq", f"WITH {TILES} SELECT design_idx || '_' || k AS read_id, seq, {_QUAL} AS qual FROM tiles")
def scan_fastq(spark, sf):
    path = fresh_path(spark, "reads")
    reads = _tiles(spark, sf).select(F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"), "seq", _qual().alias("qual"))
    W.write_fastq(reads, path)
    return fastq.read_fastq(spark, path).select("read_id", "seq", "qual")


def _written_counts(spark, sf):
    path = fresh_path(spark, "counts")
    W.write_counts(R.with_muts(V.counts(spark, sf)), V.part_library(spark, sf), 7, path)
    return path


_MUTS_SQL = f"""SELECT l_partkey + 1 AS design_idx, l_linenumber AS pos, l_returnflag AS tag, 'muts' AS measure, count(*) AS n
FROM lineitem WHERE l_suppkey % 14 <> 12 GROUP BY ALL"""


@query("s05_scan_counts_text", f"{_COUNTS_SQL.format(where='')} UNION ALL {_MUTS_SQL}")
def scan_counts_text(spark, sf):
    return C.read_counts_text(spark, f"{_written_counts(spark, sf)}/*/*")


@query("s07_scan_counts_dir", f"{_COUNTS_SQL.format(where='')} UNION ALL {_MUTS_SQL}")
def scan_counts_dir(spark, sf):
    return C.read_counts_dir(spark, _written_counts(spark, sf), partitioned=True)


@query("p08_tag_from_file_name", """SELECT DISTINCT l_returnflag AS tag, l_linestatus || '.muts' AS stem,
  CASE WHEN l_linestatus = 'O' THEN 'coverage' ELSE 'GA' END AS measure FROM lineitem""")
def tag_from_name(spark, sf):
    measure = F.when(F.col("l_linestatus") == "O", "coverage").otherwise("GA")
    files = V.table(spark, sf, "lineitem").select("l_linestatus", F.concat(
        F.lit("data/raw_counts/"), "l_returnflag", F.lit("."), measure, F.lit(".txt.gz")).alias("file")).distinct()
    tag, m = C.tag_and_measure(F.col("file"))
    return files.select(tag.alias("tag"), F.concat("l_linestatus", F.lit(".muts")).alias("stem"), m.alias("measure"))


def _csv(cells):
    return F.array_join(F.transform(cells, lambda x: x.cast("string")), ",")


def _profile_blocks(spark, sf):
    """(design_idx, header, sequence, tag, measure, m, c): a block for every design, tag and mutation type, its numbers as text.

    What a design has of a tag meets in one row, which becomes blocks only behind the joins: of these most hold zeros alone.
    """
    tasks = V.count_tasks(spark, sf)
    cells = J.to_arrays(V.counts(spark, sf).where("measure IS NOT NULL"), ["design_idx", "tag", "measure"], "n", 7)
    of_type = F.collect_list(F.when(F.col("measure") != COVERAGE, F.struct("measure", _csv(F.col("n")))))
    per = cells.groupBy("design_idx", "tag").agg(
        F.map_from_entries(of_type).alias("by"), F.max(F.when(F.col("measure") == COVERAGE, _csv(F.col("n")))).alias("c"))
    zeros = F.lit(",".join("0" * 7))
    lib = V.part_library(spark, sf).withColumn("tag", F.explode(F.array(*map(F.lit, "ANR")))).repartition(tasks, "design_idx", "tag")
    kinds = F.explode(F.array(*[F.struct(F.lit(t).alias("measure"), F.coalesce(F.try_element_at("by", F.lit(t)), zeros).alias("m")) for t in MUT_TYPES]))
    return lib.join(per, ["design_idx", "tag"], "left").select(
        "design_idx", "header", "sequence", "tag", F.coalesce("c", zeros).alias("c"), kinds.alias("x")).select("*", "x.*").drop("x")


_BLOCKS = f"""WITH {V.COV}, {V.RC}, {V.PARTS} SELECT design_idx, CAST(g.p AS INT) AS pos, tag, measure, sequence,
  coalesce(rc.n, 0) AS m, coalesce(cov.c, 0) AS c
FROM parts CROSS JOIN generate_series(1, 7) AS g(p) CROSS JOIN (VALUES ('A'), ('N'), ('R')) AS t(tag)
CROSS JOIN (SELECT unnest({V._TYPE_LIST}) AS measure)
LEFT JOIN rc ON rc.d = design_idx AND rc.p = g.p AND rc.t = tag AND rc.k = measure
LEFT JOIN cov ON cov.d = design_idx AND cov.p = g.p AND cov.t = tag"""


@query("s08_scan_count_blocks", _BLOCKS)
def scan_count_blocks(spark, sf):
    path = fresh_path(spark, "blocks")
    name = F.concat_ws("/", X.design_key(F.col("header")), "tag", "measure")
    _profile_blocks(spark, sf).select(F.concat_ws("\n", name, "sequence", "m", "c", F.lit("")).alias("value")).write.text(path)
    out = tables.read_count_blocks(spark, path)
    part = F.split("name", "/")
    return out.select(part[0].alias("name"), part[1].alias("tag"), part[2].alias("measure"), "sequence",
                      F.posexplode(F.arrays_zip("m", "c")).alias("i", "x")).select(
        (F.col("name").cast("bigint") + 1).alias("design_idx"), (F.col("i") + 1).alias("pos"), "tag", "measure", "sequence", "x.m", "x.c")


_RAW_BLOCKS = f"""WITH {V.RC} SELECT d AS design_idx, p AS pos, t AS tag, k AS measure, n FROM rc"""


def _raw_blocks(spark, sf):
    """(tag, blocks) of each tag's raw count blocks, in key order rather than library order, of the designs that have any."""
    cells = J.to_arrays(V.counts(spark, sf).where("measure <> 'coverage'"), ["design_idx", "tag", "measure"], "n", 7)
    per = cells.groupBy("design_idx", "tag").agg(F.map_from_entries(F.collect_list(F.struct("measure", "n"))).alias("by"))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), 7)
    lines = [F.concat(F.lit(f"{t} "), F.array_join(F.transform(
        F.coalesce(F.try_element_at("by", F.lit(t)), zeros), lambda x: x.cast("string")), ",")) for t in MUT_TYPES]
    named = per.join(V.part_library(spark, sf), "design_idx")
    path = fresh_path(spark, "raw-blocks")
    named.select("tag", F.concat_ws("\n", X.design_key(F.col("header")), *lines, F.lit("")).alias("value")).write.partitionBy("tag").text(path)
    return [(t, tables.read_raw_count_blocks(spark, f"{path}/tag={t}")) for t in "ANR"]


def _tagged(frames):
    return reduce(DataFrame.unionByName, [df.withColumn("tag", F.lit(t)) for t, df in frames])


@query("s09_scan_raw_count_blocks", _RAW_BLOCKS.replace("d AS design_idx", "CAST(d - 1 AS VARCHAR) AS name"))
def scan_raw_blocks(spark, sf):
    return J.to_long(_tagged(_raw_blocks(spark, sf)), ["name", "tag", "measure"], "n")


@query("j02_join_design_key", _RAW_BLOCKS)
def join_design_key(spark, sf):
    lib = V.part_library(spark, sf)
    return _tagged([(t, J.blocks_on_library(lib, df)) for t, df in _raw_blocks(spark, sf)])


@query("j02_zero_fill", """SELECT d.doc_id + 1 AS design_idx, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def zero_fill(spark, sf):
    labels = V.table(spark, sf, "labels").select((F.col("doc_id") + 1).alias("design_idx"), "quality", "toxic")
    return J.zero_filled(V.documents(spark, sf), labels, ["quality", "toxic"])


_STRUCT = "translate(sequence, 'ACGU', '.().')"


def _structures(spark, sf):
    seqs = V.documents(spark, sf).select("sequence").distinct().where("sequence <> ''")
    return seqs.select("sequence", F.translate("sequence", "ACGU", ".().").alias("structure"))


@query("s10_scan_structures_csv", f"WITH {V.LIB} SELECT DISTINCT sequence, {_STRUCT} AS structure FROM lib WHERE sequence <> ''")
def scan_structures(spark, sf):
    path = fresh_path(spark, "structures")
    _structures(spark, sf).write.option("header", True).csv(path)
    return tables.read_structures(spark, path)


@query("j03_join_structure_by_sequence", f"WITH {V.LIB} SELECT design_idx, sequence, CASE WHEN sequence <> '' THEN {_STRUCT} END AS structure FROM lib")
def join_structure(spark, sf):
    return J.structures_for(V.documents(spark, sf), _structures(spark, sf))


@query("e13_structure_map", f"""WITH {V.LIB} SELECT design_idx, len(sequence) AS size,
  length(sequence) - length(replace(replace({_STRUCT}, '(', ''), ')', '')) AS paired FROM lib WHERE sequence <> ''""".replace("len(sequence)", "length(sequence)").replace("length(sequence) AS size", "CAST(length(sequence) AS INT) AS size").replace("length(sequence) - length(replace", "CAST(length(sequence) - length(replace").replace("')', '')) AS paired", "')', '')) AS INT) AS paired"))
def structure_map(spark, sf):
    m = V.documents(spark, sf).where("sequence <> ''").select(
        "design_idx", X.structure_map(F.translate("sequence", "ACGU", ".().")).alias("m"))
    ones = F.aggregate("m", F.lit(0), lambda acc, x: acc + x)
    return m.select("design_idx", F.size("m").alias("size"), (F.size("m") - ones).alias("paired"))


def _alignments(spark, sf):
    """Tiles as alignments: mismatches, one deletion or one insertion in each full tile."""
    t = _tiles(spark, sf)
    seq, k = F.col("seq"), F.col("k")
    full, off = F.length(seq) == 60, ((F.col("design_idx") + k) % 60).cast("int")
    one = F.concat(F.substring(seq, F.lit(1), off), F.translate(F.substring(seq, off + 1, F.lit(1)), "ACGT", "CGTA"),
                   F.substring(seq, off + 2, F.lit(60)))
    two = F.concat(F.substring(seq, F.lit(1), off), F.translate(F.substring(seq, off + 1, F.lit(2)), "ACGT", "CGTA"),
                   F.substring(seq, off + 3, F.lit(60)))
    kind = F.when(~full, "tail").when(k % 3 == 1, "del").when(k % 3 == 2, "ins").when(k % 6 == 0, "two").otherwise("one")
    t = t.withColumn("kind", kind)
    mutated = (
        F.when(kind == "del", F.concat(F.substring(seq, 1, 29), F.substring(seq, 31, 30)))
        .when(kind == "ins", F.concat(F.substring(seq, 1, 30), F.lit("A"), F.substring(seq, 31, 30)))
        .when(kind == "two", two).when(kind == "one", one).otherwise(seq)
    )
    cigar = F.when(kind == "del", "29M1D30M").when(kind == "ins", "30M1I30M").otherwise(
        F.concat(F.length(seq).cast("string"), F.lit("M")))
    return t.select(
        F.concat_ws("_", F.col("design_idx").cast("string"), k.cast("string")).alias("read_id"),
        F.when(k % 7 == 0, 256).when(k % 5 == 0, 16).otherwise(0).alias("flag"),
        (F.col("design_idx") - 1).cast("string").alias("ref"), F.col("start").alias("pos"),
        (k % 42).cast("int").alias("mapq"), cigar.alias("cigar"), mutated.alias("seq"), "kind", "design_idx", "k",
    )


_ALN = f"""{TILES}, k0 AS (
  SELECT *, CAST((design_idx + k) % 60 AS INT) AS off,
    CASE WHEN length(seq) < 60 THEN 'tail' WHEN k % 3 = 1 THEN 'del' WHEN k % 3 = 2 THEN 'ins'
         WHEN k % 6 = 0 THEN 'two' ELSE 'one' END AS kind FROM tiles),
aln AS (SELECT design_idx, k, dna, start, off, kind, design_idx || '_' || k AS read_id,
    CAST(CASE WHEN k % 7 = 0 THEN 256 WHEN k % 5 = 0 THEN 16 ELSE 0 END AS INT) AS flag,
    CAST(design_idx - 1 AS VARCHAR) AS ref, CAST(start AS INT) AS pos, CAST(k % 42 AS INT) AS mapq, length(seq) AS n,
    CASE WHEN kind = 'del' THEN '29M1D30M' WHEN kind = 'ins' THEN '30M1I30M' ELSE length(seq) || 'M' END AS cigar,
    CASE WHEN kind = 'del' THEN substr(seq, 1, 29) || substr(seq, 31, 30)
         WHEN kind = 'ins' THEN substr(seq, 1, 30) || 'A' || substr(seq, 31, 30)
         WHEN kind = 'two' THEN substr(seq, 1, off) || translate(substr(seq, off + 1, 2), 'ACGT', 'CGTA') || substr(seq, off + 3, 60)
         WHEN kind = 'one' THEN substr(seq, 1, off) || translate(substr(seq, off + 1, 1), 'ACGT', 'CGTA') || substr(seq, off + 2, 60)
         ELSE seq END AS seq
  FROM k0)"""
_ALN_COLS = "read_id, flag, ref, pos, mapq, cigar, seq"


@query("s11_scan_sam", f"WITH {_ALN} SELECT {_ALN_COLS}, k % 9 + 1 AS dup_count FROM aln".replace("k % 9 + 1 AS dup", "CAST(k % 9 + 1 AS BIGINT) AS dup"))
def scan_sam(spark, sf):
    a = _alignments(spark, sf)
    line = F.concat_ws("\t", "read_id", F.col("flag").cast("string"), "ref", F.col("pos").cast("string"),
                       F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", F.lit("*"),
                       F.concat(F.lit("dc:i:"), (F.col("k") % 9 + 1).cast("string")))
    path = fresh_path(spark, "sam")
    a.select(F.when(F.col("k") == 0, F.concat(F.lit("@SQ\tSN:x\n"), line)).otherwise(line).alias("value")).write.text(path)
    return tables.read_sam(spark, path).select("read_id", "flag", "ref", "pos", "mapq", "cigar", "seq", "dup_count")


@query("s12_scan_result_table", _NORMED.replace("FROM blanked LEFT JOIN nv", "FROM (SELECT * FROM blanked WHERE d >= 51) blanked LEFT JOIN nv"))
def scan_result(spark, sf):
    a = A.analyse(written(V.counts(spark, sf), "counts"), V.part_library(spark, sf), V.CONDITIONS, blank5=1, blank3=1)
    path = fresh_path(spark, "result")
    write_bundle(a, path, ("reactivity",))
    out = read_table(spark, path, "reactivity", (51, None)).drop("seq_len")
    return V.rounded(out, "r", "r_err", "r_nomod")


_LOGS = """SELECT 'runs/' || user_id AS run, CAST(no AS INT) AS stage_no, stage, CAST(sum(v) AS BIGINT) AS n_reads FROM (
  SELECT user_id, event_id, CAST(floor(value * 100) AS BIGINT) AS v,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 5 WHEN 'purchase' THEN 6 ELSE 9 END AS no,
    CASE event_type WHEN 'view' THEN 'into_merge' WHEN 'click' THEN 'merged' WHEN 'signup' THEN 'into_align'
      WHEN 'purchase' THEN 'aligned' ELSE 'counted' END AS stage FROM events)
GROUP BY ALL"""


@query("s14_scan_run_logs", f"""{_LOGS} UNION ALL SELECT 'runs/' || user_id, 8, 'into_count',
  CAST(sum(2 * CAST(floor(value * 100) AS BIGINT)) AS BIGINT) FROM events WHERE event_type = 'error' GROUP BY ALL""")
def scan_logs(spark, sf):
    e, kind = V.table(spark, sf, "events"), F.col("event_type")
    v = F.floor(F.col("value") * 100)
    text, twice = v.cast("string"), (v * 2).cast("string")
    name = F.when(kind.isin("view", "click"), "0_merge_pairs.err").when(
        kind.isin("signup", "purchase"), "2_align/T/bowtie2.err").otherwise("3_count/count.out")
    line = (
        F.when(kind == "view", F.concat(F.lit("Pairs:               \t"), text))
        .when(kind == "click", F.concat(F.lit("Joined:              \t"), text, F.lit("   \t75.5%")))
        .when(kind == "signup", F.concat(text, F.lit(" reads; of these:")))
        .when(kind == "purchase", F.concat(F.lit("    "), text, F.lit(" (50.00%) aligned exactly 1 time")))
        .otherwise(F.concat(F.lit('  [*] Sample "x": 9 transcripts covered [A: 1; C: 2] - '), text, F.lit("/"), twice,
                            F.lit(" (50.00%) mutated alignments")))
    )
    lines = e.select(F.concat(F.lit("runs/"), F.col("user_id").cast("string"), F.lit("/"), name).alias("file"), line.alias("value"))
    return tables.log_stages(lines)


@query("s16_build_index", f"""WITH {V.LIB} SELECT kmer, count(*) AS places, min(design_idx) AS first_design FROM (
  SELECT design_idx, substr(sequence, i, 12) AS kmer FROM (
    SELECT *, unnest(generate_series(1, length(sequence) - 11)) AS i FROM lib WHERE length(sequence) >= 12))
GROUP BY kmer""")
def index(spark, sf):
    return build_index(V.documents(spark, sf), 12).groupBy("kmer").agg(
        F.count("*").alias("places"), F.min("design_idx").alias("first_design"))


# Validation and filters ----------------------------------------------------------------------------

@query("f01_check_alphabet", "SELECT doc_id + 1 AS design_idx, regexp_full_match(upper(text), '[ACGTUN]*') AS valid FROM documents")
def check_alphabet(spark, sf):
    d = V.table(spark, sf, "documents")
    return K.check_alphabet(d.select((F.col("doc_id") + 1).alias("design_idx"), F.upper("text").alias("sequence")))


@query("f02_check_dup", f"""WITH {V.LIB} SELECT design_idx, ordinal, sequence FROM (
  SELECT design_idx, sequence, row_number() OVER (ORDER BY design_idx) AS ordinal,
    row_number() OVER (PARTITION BY sequence ORDER BY design_idx) AS k FROM lib WHERE sequence <> '') WHERE k > 1""")
def check_dup(spark, sf):
    return K.repeated_values(V.documents(spark, sf))


_TEMPLATE = "NNA" + "N" * 57


@query("f09_filter_exact_length_match", f"""WITH {_ALN} SELECT read_id, seq FROM aln
WHERE cigar = '60M' AND k % 9 + 1 >= 3 AND substr(seq, 3, 1) = 'A'""")
def exact_length(spark, sf):
    a = _alignments(spark, sf).withColumn("dup_count", F.col("k") % 9 + 1)
    return D.exact_length_matches(a, _TEMPLATE, 3).select("read_id", "seq")


@query("e19_degenerate_label", f"""WITH {_ALN} SELECT read_id, replace(substr(seq, 1, 2) || '_' || substr(seq, 4, 2) || '_' || substr(seq, 8, 1), 'T', 'U')
  || ' counts:' || (k % 9 + 1) AS label FROM aln""")
def degenerate(spark, sf):
    label = X.degenerate_label(F.col("seq"), "NNANNGGN", F.col("k") % 9 + 1)
    return _alignments(spark, sf).select("read_id", label.alias("label"))


@query("f10_filter_min_mapq", f"WITH {_ALN} SELECT {_ALN_COLS} FROM aln WHERE mapq >= 10")
def min_mapq(spark, sf):
    return D.min_mapq(_alignments(spark, sf)).select(*_ALN_COLS.split(", "))


@query("f11_filter_min_read_length", f"""WITH {V.LIB}, cut AS (SELECT CAST(floor(min(length(sequence)) * 0.92) AS INT) AS c FROM lib WHERE sequence <> '')
SELECT conv_id, turn, length(s) AS n FROM (SELECT conv_id, turn, replace(upper(regexp_replace(text, '[^ACGTUacgtu]', '', 'g')), 'T', 'U') AS s
FROM conversations), cut WHERE length(s) >= c""".replace("length(s) AS n", "CAST(length(s) AS INT) AS n"))
def min_length(spark, sf):
    cutoff = K.length_cutoff(V.documents(spark, sf).where("sequence <> ''")).scalar()
    reads = V.table(spark, sf, "conversations").select("conv_id", "turn", F.length(V.text_sequence("text")).alias("n"))
    return reads.where(F.col("n") >= cutoff)


@query("f12_filter_max_edit_distance", f"WITH {_ALN} SELECT read_id FROM aln WHERE (k % 8) / length(seq) <= 0.1")
def max_edit(spark, sf):
    return D.max_edit_rate(_alignments(spark, sf).withColumn("nm", F.col("k") % 8), 0.1).select("read_id")


@query("f13_filter_sam_flags", f"WITH {_ALN} SELECT {_ALN_COLS} FROM aln WHERE flag & 2304 = 0")
def sam_flags(spark, sf):
    return D.primary_alignments(_alignments(spark, sf)).select(*_ALN_COLS.split(", "))


_ADAPTER_CASES = "\n".join(
    f"WHEN s LIKE '%{'AGATCGGAAGAGCGGTTCAG'[:k]}' THEN length(s) - {k}" for k in range(19, 2, -1))


@query("f18_quality_and_adapter_trim", f"""WITH {TILES}, q AS (SELECT design_idx || '_' || k AS read_id,
  CASE k % 4 WHEN 0 THEN substr(seq, 1, 30) || 'AGATCGGAAGAGCGGTTCAG' || substr(seq, 51, 10)
             WHEN 1 THEN substr(seq, 1, 40) || 'AGATCG' ELSE seq END AS seq, design_idx FROM tiles),
t AS (SELECT *, {_QUAL} AS qual FROM q),
u AS (SELECT read_id, qual, substr(seq, 1, length(rtrim(qual, '!"#$%&''()*+,-./0123456789:;<=>'))) AS s FROM t),
v AS (SELECT *, CASE WHEN strpos(s, 'AGATCGGAAGAGCGGTTCAG') > 0 THEN strpos(s, 'AGATCGGAAGAGCGGTTCAG') - 1
{_ADAPTER_CASES} ELSE length(s) END AS n FROM u)
SELECT read_id, substr(s, 1, n) AS seq, substr(qual, 1, n) AS qual FROM v WHERE n >= 20""")
def trim_reads(spark, sf):
    t, k = _tiles(spark, sf), F.col("k")
    seq = F.when(k % 4 == 0, F.concat(F.substring("seq", 1, 30), F.lit("AGATCGGAAGAGCGGTTCAG"), F.substring("seq", 51, 10))).when(
        k % 4 == 1, F.concat(F.substring("seq", 1, 40), F.lit("AGATCG"))).otherwise(F.col("seq"))
    reads = t.select(F.concat_ws("_", F.col("design_idx").cast("string"), k.cast("string")).alias("read_id"), seq.alias("seq"), "design_idx")
    return D.quality_and_adapter_trim(reads.withColumn("qual", _qual())).select("read_id", "seq", "qual")


# Strings -------------------------------------------------------------------------------------------

def _on_library(name, sql, column):
    @query(name, f"WITH {V.LIB} SELECT design_idx, {sql} AS value FROM lib")
    def run(spark, sf):
        return V.documents(spark, sf).select("design_idx", column().alias("value"))
    return run


_DNA = "replace(sequence, 'U', 'T')"
_on_library("e01_rna_dna", _DNA, lambda: X.to_dna(X.to_rna(F.col("sequence"))))
_on_library("e02_prepend_promoter", f"'TTCTAATACGACTCACTATA' || {_DNA}", lambda: X.with_promoter(F.col("sequence")))
_on_library("e03_excise_reference_end", "substr(sequence, 1, greatest(length(sequence) - 12, 0))", lambda: X.excise_end(F.col("sequence"), 12))
_on_library("e03_excise_read_start", "substr(sequence, 13)", lambda: X.excise_start(F.col("sequence"), 12))
_on_library("e04_reverse_complement", f"translate(reverse({_DNA}), 'ACGT', 'TGCA')", lambda: X.reverse_complement(F.col("sequence")))
_on_library("e05_design_key", "replace(regexp_extract(lang || '/' || header, '^\\s*(\\S*)', 1), '/', '_')",
            lambda: X.design_key(F.concat("lang", F.lit("/"), "header")))
_on_library("e14_file_stem", "trim(translate(regexp_replace('(' || source || ', ' || header || ')', '[,()]', '', 'g'), '/ ' || chr(9), '__ '))",
            lambda: X.file_stem(F.concat(F.lit("("), "source", F.lit(", "), "header", F.lit(")"))))
_on_library("e20_ultima_prefix", "'CTACACGACGCTCTTCCGATCT' || sequence", lambda: X.ultima_barcode(F.col("sequence")))


@query("e06_trim_3prime_adapter", f"""WITH {V.LIB} SELECT design_idx, substr(sequence, 1, strpos(sequence, 'ACUA') - 1) AS seq
FROM lib WHERE strpos(sequence, 'ACUA') > 0""")
def trim3(spark, sf):
    reads = V.documents(spark, sf).select("design_idx", F.col("sequence").alias("seq"))
    return D.trim_adapter(reads, three_prime="ACUA")


@query("e06_trim_5prime_adapter", f"""WITH {V.LIB} SELECT design_idx, substr(sequence, strpos(sequence, 'ACUA') + 4) AS seq
FROM lib WHERE strpos(sequence, 'ACUA') > 0""")
def trim5(spark, sf):
    reads = V.documents(spark, sf).select("design_idx", F.col("sequence").alias("seq"))
    return D.trim_adapter(reads, five_prime="ACUA")


@query("e07_pad_zeros", """SELECT l_orderkey, rpad(v, CAST(greatest(n, 8) AS INT), ' ') = v AS full, array_to_string(list_resize(list_value_, greatest(n, 8), 0), ',') AS padded
FROM (SELECT l_orderkey, '' AS v, count(*) AS n, list(CAST(l_quantity AS BIGINT) ORDER BY l_linenumber, l_quantity) AS list_value_
FROM lineitem GROUP BY l_orderkey)""".replace("rpad(v, CAST(greatest(n, 8) AS INT), ' ') = v AS full", "n >= 8 AS full"))
def pad(spark, sf):
    rows = V.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q")))).alias("a"))
    padded = X.pad_zeros(F.col("a.q"), F.greatest(F.size("a"), F.lit(8)))
    return rows.select("l_orderkey", (F.size("a") >= 8).alias("full"),
                       F.array_join(F.transform(padded, lambda x: x.cast("string")), ",").alias("padded"))


@query("e15_annotations", f"""WITH {V.LIB} SELECT design_idx, CASE WHEN lang = 'en'
  THEN 'lib:id:' || (design_idx - 1) || '|lib:design_name:' || source || '|lib:author:' || lang
  ELSE 'name:' || replace(header, chr(9), ';') END AS annotations FROM lib""")
def annotate(spark, sf):
    lib = V.documents(spark, sf)
    known = F.when(F.col("lang") == "en", (F.col("design_idx") - 1).cast("double"))
    notes = X.annotations("lib", known, F.col("source"), F.col("lang"), F.col("header"))
    return lib.select("design_idx", F.array_join(notes, "|").alias("annotations"))


@query("e16_join_names", "SELECT l_linestatus, string_agg(l_returnflag, '_' ORDER BY l_returnflag) AS name FROM (SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem) GROUP BY ALL")
def join_names(spark, sf):
    tags = V.table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag").distinct()
    return tags.groupBy("l_linestatus").agg(F.array_join(F.array_sort(F.collect_list("l_returnflag")), "_").alias("name"))


_FIXED = f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT} SELECT d AS design_idx, p AS pos, cond_idx,
  CAST(round(CAST(round(r, 9) AS DECIMAL(38, 9)), 3) AS VARCHAR) AS r FROM react WHERE r IS NOT NULL"""


@query("e18_fixed_format", _FIXED)
def fixed_format(spark, sf):
    r = R.combine_profiles(R.subtract_background(V.counts(spark, sf), V.CONDITIONS, tasks=V.count_tasks(spark, sf))).where("r IS NOT NULL")
    return V.rounded(r, "r").select("design_idx", "pos", "cond_idx", X.fixed3(F.col("r")).alias("r"))


@query("e17_missing_as_blank", f"""WITH {V.COV}, {V.RC}, {V.COND}, {V.TAGS}, {V.SUB}, {V.REACT} SELECT d AS design_idx, p AS pos, cond_idx,
  r IS NULL AS blank FROM react""")
def missing_blank(spark, sf):
    r = R.combine_profiles(R.subtract_background(V.counts(spark, sf), V.CONDITIONS, tasks=V.count_tasks(spark, sf)))
    path = fresh_path(spark, "csv")
    r.select("design_idx", "pos", "cond_idx", X.fixed3(F.col("r")).alias("r")).write.option("nullValue", "").csv(path)
    back = spark.read.schema("design_idx bigint, pos int, cond_idx int, r string").csv(path)
    return back.select("design_idx", "pos", "cond_idx", F.col("r").isNull().alias("blank"))


@query("e22_read_overlap", """SELECT conv_id, turn, CAST(length(text) + length(role) - (150 + 12) AS INT) AS overlap,
  length(text) + length(role) - (150 + 12) >= 12 AS can_merge FROM conversations""")
def read_overlap(spark, sf):
    o = K.insert_overlap(F.length("text"), F.length("role"), F.lit(150), F.lit(12))
    return V.table(spark, sf, "conversations").select("conv_id", "turn", o.alias("overlap"), (o >= 12).alias("can_merge"))


# Read-level joins and aggregates -------------------------------------------------------------------

@query("j04_join_tag_name", f"""WITH {V.COND}, roles AS (SELECT cond_idx, true AS treated, s AS tag FROM cond
  UNION ALL SELECT cond_idx, false, n FROM cond WHERE n IS NOT NULL)
SELECT cond_idx, treated, tag, count(l.t) AS matches FROM roles LEFT JOIN (SELECT DISTINCT l_returnflag AS t FROM lineitem) l ON l.t = tag GROUP BY ALL""")
def join_tag_name(spark, sf):
    tags = V.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("tag")).distinct()
    return J.tag_matches(tags, V.CONDITIONS)


_BC = "bc AS (SELECT * FROM (VALUES ('BC1', 'CTA'), ('BC2', 'GAC'), ('BC3', 'ACG'), ('BC4', 'TTT')) AS v(tag, code))"
_HAM = " + ".join(f"CASE WHEN substr(seq, {i}, 1) = substr(code, {i}, 1) THEN 0 ELSE 1 END" for i in (1, 2, 3))


@query("j06_join_read_barcode", f"""WITH {TILES}, {_BC}, h AS (
  SELECT design_idx, k, seq, tag, {_HAM} AS dist FROM tiles CROSS JOIN bc WHERE length(seq) >= 3),
b AS (SELECT *, min(dist) OVER (PARTITION BY design_idx, k) AS best FROM h)
SELECT design_idx || '_' || k AS read_id, any_value(tag) AS tag, any_value(substr(seq, 4)) AS seq
FROM b WHERE dist = best AND best <= 1 GROUP BY design_idx, k HAVING count(*) = 1""")
def join_barcode(spark, sf):
    reads = _tiles(spark, sf).select(F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"), "seq")
    return D.demultiplex(reads, list(V.BARCODES)).select("read_id", "tag", "seq")


@query("j07_join_filename_barcode", f"""WITH {_BC}, {V.LIB}, files AS (
  SELECT DISTINCT source || '/' || replace(substr(sequence, 1, 12), 'U', 'T') || '.fastq' AS file FROM lib)
SELECT file, tag FROM files, bc WHERE contains(file, code) OR contains(file, tag)""")
def file_barcode(spark, sf):
    start = X.to_dna(F.substring("sequence", F.lit(1), F.lit(12)))
    files = V.documents(spark, sf).select(F.concat("source", F.lit("/"), start, F.lit(".fastq")).alias("file")).distinct()
    return D.files_by_barcode(files, list(V.BARCODES))


_FRAGS = f"""{V.LIB}, frags AS (SELECT design_idx, k, replace(substr(sequence, 100 * k + 1, 100), 'U', 'T') AS frag
  FROM (SELECT *, unnest(generate_series(0, (length(sequence) - 1) // 100)) AS k FROM lib WHERE sequence <> '')),
mates AS (SELECT design_idx || '_' || k AS read_id, design_idx % 2 = 1 AS second, substr(frag, 1, 60) AS a,
    CASE WHEN length(frag) > 60 THEN substr(frag, length(frag) - 59) ELSE frag END AS b FROM frags),
ov AS (SELECT *, coalesce(list_filter(range(least(length(a), length(b)), 11, -1),
    lambda o: hamming(substr(a, CAST(length(a) - o + 1 AS INT)), substr(b, 1, CAST(o AS INT))) <= 0.1 * o)[1], 0) AS o FROM mates)"""


@query("j09_merge_pairs", f"""WITH {_FRAGS} SELECT read_id, o > 0 AS merged, CAST(o AS INT) AS overlap,
  CASE WHEN o = 0 THEN a WHEN second THEN substr(a, 1, CAST(length(a) - o AS INT)) || b
    ELSE a || substr(b, CAST(o + 1 AS INT)) END AS seq, CASE WHEN o = 0 THEN b END AS mate_seq FROM ov""")
def merge_pairs(spark, sf):
    lib = V.documents(spark, sf).where("sequence <> ''")
    frag = lib.select("design_idx", "sequence", F.explode(F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / 100).cast("int"))).alias("k")).select(
        F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"),
        X.to_dna(F.substring("sequence", F.col("k") * 100 + 1, F.lit(100))).alias("frag"))
    first = frag.select("read_id", F.substring("frag", 1, 60).alias("seq")).withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))
    tail = F.substring("frag", F.greatest(F.length("frag") - 59, F.lit(1)), F.lit(60))
    better = F.when(F.substring_index("read_id", "_", 1).cast("bigint") % 2 == 1, "J").otherwise("H")
    second = frag.select("read_id", X.reverse_complement(tail).alias("seq"), F.repeat(better, F.length(tail)).alias("qual"))
    return P.merge_pairs(first, second).drop("qual", "mate_qual")


_PILE = f"""{_ALN}, ev AS (
  SELECT design_idx, start + off AS p, kind, substr(dna, CAST(start + off AS INT), 1) AS r FROM aln WHERE kind = 'one'
  UNION ALL SELECT design_idx, start + least(off + 1, 59), kind, substr(dna, CAST(start + least(off + 1, 59) AS INT), 1) FROM aln WHERE kind = 'two'),
dels AS (SELECT design_idx, start + 29 + least(length(substr(dna, CAST(start + 29 AS INT))) - length(ltrim(substr(dna, CAST(start + 29 AS INT)), substr(dna, CAST(start + 29 AS INT), 1))) - 1, 30) AS p FROM aln WHERE kind = 'del'),
piled AS (
  SELECT design_idx, p, r || translate(r, 'ACGT', 'CGTA') AS measure, 1 AS n FROM ev
  UNION ALL SELECT design_idx, p, 'del', 1 FROM dels
  UNION ALL SELECT design_idx, start + 29, 'ins', 1 FROM aln WHERE kind = 'ins'
  UNION ALL SELECT design_idx, start + unnest(generate_series(0, CASE WHEN kind = 'tail' THEN n - 1 ELSE 59 END)), 'coverage', 1 FROM aln)"""


@query("a21_pileup", f"""WITH {_PILE} SELECT design_idx, CAST(p AS INT) AS pos, 'all' AS tag, measure, count(*) AS n FROM piled GROUP BY ALL""")
def pileup(spark, sf):
    lib = V.documents(spark, sf).select("design_idx", (F.col("design_idx") - 1).cast("string").alias("name"), "sequence")
    return U.pileup(_alignments(spark, sf).drop("design_idx").withColumn("tag", F.lit("all")), lib)


@query("f19_min_base_quality", f"""WITH {TILES}, q AS (SELECT *, {_QUAL} AS qual FROM tiles),
e AS (SELECT design_idx, start, qual, unnest(generate_series(1, length(seq))) AS i FROM q)
SELECT design_idx, CAST(start + i - 1 AS INT) AS pos, count(*) AS n FROM e WHERE ascii(substr(qual, CAST(i AS INT), 1)) - 33 >= 25 GROUP BY ALL""")
def base_quality(spark, sf):
    lib = V.documents(spark, sf).select("design_idx", (F.col("design_idx") - 1).cast("string").alias("name"), "sequence")
    reads = _tiles(spark, sf).select(
        F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"), F.lit("all").alias("tag"),
        (F.col("design_idx") - 1).cast("string").alias("ref"), F.col("start").alias("pos"),
        F.concat(F.length("seq").cast("string"), F.lit("M")).alias("cigar"), "seq", _qual().alias("qual"))
    out = U.pileup(reads, lib, min_base_quality=25)
    return out.where("measure = 'coverage'").select("design_idx", "pos", "n")


@query("a23_dedup_umi", f"""WITH {_ALN}, u AS (SELECT *, substr(seq, 1, 4) AS umi FROM aln)
SELECT ref, pos, flag & 16 <> 0 AS strand, umi, min(read_id) AS read_id FROM u GROUP BY ref, pos, flag & 16 <> 0, umi""")
def dedup(spark, sf):
    a = _alignments(spark, sf).select("read_id", "ref", F.col("pos").cast("int").alias("pos"), "flag", F.substring("seq", 1, 4).alias("umi"))
    return D.dedup_umi(a).select("ref", "pos", (F.col("flag").bitwiseAND(16) != 0).alias("strand"), "umi", "read_id")


@query("a24_markdup_count", f"""WITH {TILES} SELECT 'x' AS ref, CAST(k AS INT) AS pos, length(seq) || 'M' AS cigar, seq, count(*) AS dup_count FROM tiles GROUP BY ALL""")
def markdup(spark, sf):
    return D.mark_duplicates(_tiles(spark, sf).select(
        F.lit("x").alias("ref"), F.col("k").alias("pos"), F.concat(F.length("seq").cast("string"), F.lit("M")).alias("cigar"), "seq"))


@query("o01_sort_alignments", f"WITH {_ALN} SELECT {_ALN_COLS} FROM aln ORDER BY ref, pos")
def sort_alignments(spark, sf):
    return D.sort_alignments(_alignments(spark, sf)).select(*_ALN_COLS.split(", "))


@query("p10_read_chunks", """SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 700 + 1 AS BIGINT) AS chunk FROM events""")
def read_chunks(spark, sf):
    return D.read_chunks(V.table(spark, sf, "events").select("event_id", F.col("event_id").alias("ordinal")), 700).drop("ordinal")


@query("w07_chunk_ordinal", f"WITH {V.LIB} SELECT design_idx, CAST((row_number() OVER (ORDER BY design_idx) - 1) // 100 + 1 AS BIGINT) AS chunk FROM lib")
def chunk_ordinal(spark, sf):
    lib = V.documents(spark, sf)
    return D.read_chunks(lib.select("design_idx", F.col("design_idx").alias("ordinal")), 100).drop("ordinal")


_TRIM = "CASE WHEN strpos({0}, 'ACTA') > 0 THEN substr({0}, 1, strpos({0}, 'ACTA') - 1) WHEN strpos({0}, 'GTC') > 0 THEN substr({0}, strpos({0}, 'GTC') + 3) END"
_PASS = "coalesce(" + _TRIM.format("seq") + ", " + _TRIM.format("translate(reverse(seq), 'ACGT', 'TGCA')") + ")"


@query("u10_concat_trimmed_reads", f"""WITH {TILES}, p1 AS (SELECT design_idx, k, {_PASS} AS seq FROM tiles),
p2 AS (SELECT design_idx, k, {_PASS} AS seq FROM p1 WHERE seq IS NOT NULL)
SELECT design_idx || '_' || k AS read_id, seq FROM p2 WHERE seq IS NOT NULL""")
def concat_trimmed(spark, sf):
    reads = _tiles(spark, sf).select(F.concat_ws("_", F.col("design_idx").cast("string"), F.col("k").cast("string")).alias("read_id"), "seq", "k")
    files = [reads.where(F.col("k") % 2 == i).select("read_id", "seq") for i in (0, 1)]
    cleaned = [D.clean_long_reads(f, "ACTA", "GTC") for f in files]
    return cleaned[0].unionByName(cleaned[1])
