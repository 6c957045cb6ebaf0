"""Tables for users: labels, examples, coverage and reads, reactivity entries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..functions.text import annotations, fixed3
from ..operators.joins import key_columns, position_columns
from ..operators.normalize import blank_ends
from ..operators.signal import classify_signal, signal_to_noise
from ..plans.analysis import Analysis

ENTRY_CHUNK = 10000


def value_arrays(a: Analysis, cond_idx: int, length: int, columns=("r", "r_err")) -> DataFrame:
    """Dense arrays of ``length`` values per design for one condition; missing stays missing."""
    rows = a.reactivity.where(F.col("cond_idx") == cond_idx)
    packed = rows.groupBy("design_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.struct(*columns)))).alias("_m")
    )
    def cells(c: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda p: F.try_element_at("_m", p)[c])

    return packed.select("design_idx", *[cells(c).alias(c) for c in columns])


def labels_table(a: Analysis, cond_idx: int, length: int, experiment_type: str, dataset_name: str,
                 id_label: str = "id", sn_cutoff: float = 1.0, reads_cutoff: int = 100) -> DataFrame:
    """One row per design for training data: identity, quality, and a column per position.

    Errors are blanked with the values. Numbers have three decimals as text;
    missing ones are NULL, which the CSV writer leaves blank.
    """
    blanked = blank_ends(a.reactivity, a.blank5, a.blank3, ["r", "r_err"])
    arrays = value_arrays(replace(a, reactivity=blanked), cond_idx, length)
    wide = position_columns(
        arrays.select("design_idx", F.transform("r", fixed3).alias("v")), ["design_idx"], "v", length, "reactivity"
    ).join(position_columns(
        arrays.select("design_idx", F.transform("r_err", fixed3).alias("v")), ["design_idx"], "v", length,
        "reactivity_error",
    ), "design_idx")
    quality = a.signal_to_noise.where(F.col("cond_idx") == cond_idx).join(
        a.reads.where(F.col("cond_idx") == cond_idx).drop("cond_idx"), "design_idx", "left"
    ).withColumn("reads", F.coalesce("reads", F.lit(0)))
    passes = (F.col("signal_to_noise") >= sn_cutoff) & (F.col("reads") >= reads_cutoff)
    head = a.library.select("design_idx", F.split("header", "\t")[0].alias(id_label), "sequence").join(
        quality.select("design_idx", "reads", fixed3(F.col("signal_to_noise")).alias("signal_to_noise"),
                       passes.cast("int").alias("SN_filter")), "design_idx")
    return head.select(
        "design_idx", id_label, "sequence", F.lit(experiment_type).alias("experiment_type"),
        F.lit(dataset_name).alias("dataset_name"), "reads", "signal_to_noise", "SN_filter",
    ).join(wide, "design_idx")


def examples_table(library: DataFrame, structures: DataFrame, id_label: str = "id") -> DataFrame:
    """Identity, sequence and any structure columns, by design."""
    return library.select("design_idx", F.split("header", "\t")[0].alias(id_label), "sequence").join(
        structures, "design_idx", "left"
    )


def coverage_table(a: Analysis) -> DataFrame:
    """Header, sequence and a coverage column per tag."""
    wide = key_columns(a.coverage, ["design_idx"], "tag", a.tags, "coverage")
    return _with_zero(a.library.select("design_idx", "header", "sequence").join(wide, "design_idx", "left"), a.tags)


def reads_table(a: Analysis) -> DataFrame:
    """Header, sequence and a reads column per condition, named after it."""
    names = {c.cond_idx: c.name for c in a.conditions}
    wide = key_columns(a.reads, ["design_idx"], "cond_idx", list(names), "reads")
    out = _with_zero(a.library.select("design_idx", "header", "sequence").join(wide, "design_idx", "left"), map(str, names))
    return out.withColumnsRenamed({str(i): f"{i}_{n}" for i, n in names.items()})


def _with_zero(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({str(c): F.coalesce(str(c), F.lit(0)) for c in columns})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files in library order, missing values blank."""
    df.orderBy("design_idx").drop("design_idx").write.option("header", True).option("nullValue", "").csv(path)


def entry_annotations(a: Analysis, cond_idx: int, prefix: str, sn_cutoff: float = 1.0,
                      reads_cutoff: int = 100) -> DataFrame:
    """Per design: signal-to-noise over the published positions, quality, and its annotation list.

    The first and last published points are left out again in this ratio, as
    in every signal-to-noise.
    """
    rows = a.reactivity.where(F.col("cond_idx") == cond_idx)
    sn = signal_to_noise(rows, None, a.blank5, a.blank3).withColumnRenamed("signal_to_noise", "_sn").drop("cond_idx")
    kept = a.signal_to_noise.where(F.col("cond_idx") == cond_idx).select("design_idx", "signal_to_noise")
    reads = a.reads.where(F.col("cond_idx") == cond_idx).select("design_idx", "reads")
    d = a.library.join(sn, "design_idx").join(kept, "design_idx").join(reads, "design_idx", "left").withColumn(
        "reads", F.coalesce("reads", F.lit(0)))
    good = (F.col("signal_to_noise") >= sn_cutoff) & (F.col("reads") >= reads_cutoff)
    has_info = {"id", "title", "author"} <= set(a.library.columns)
    extra = annotations(prefix, *(F.col(c) if has_info else F.lit(None) for c in ("id", "title", "author")), F.col("header"))
    if not has_info:
        extra = F.array(F.concat(F.lit("name:"), F.translate("header", "\t", ";")))
    structure = F.when(F.col("structure").isNotNull(), F.concat(F.lit("structure:"), "structure")) if (
        "structure" in a.library.columns) else F.lit(None).cast("string")
    own = F.array_compact(F.array(
        F.concat(F.lit("sequence:"), "sequence"), structure,
        F.concat(F.lit("reads:"), F.col("reads").cast("string")),
        F.concat(F.lit("signal_to_noise:"), classify_signal(F.col("_sn")), F.lit(":"), F.trim(fixed3(F.col("_sn")))),
    ))
    bad = F.when(~good, F.array(F.lit("warning:badQuality"))).otherwise(F.array().cast("array<string>"))
    return d.select("design_idx", good.alias("good"), F.concat(own, extra, bad).alias("annotations"))


def entry_lines(a: Analysis, cond_idx: int, length: int, prefix: str, name: str, annotations_all: list[str] = (),
                comments: list[str] = (), keep_bad: bool = True, chunk_designs: int = ENTRY_CHUNK) -> DataFrame:
    """Text lines (chunk, section, design_idx, value) of the reactivity entry file of one condition.

    Sections: 0 the file's head, 1 a design's annotations, 2 its values, 3 its
    errors; only positions inside the blanked ends are published. Libraries
    of any size are cut into files of ``chunk_designs`` by ordinal.
    """
    chunk = F.floor((F.col("design_idx") - 1) / chunk_designs) + 1
    notes = entry_annotations(a, cond_idx, prefix)
    if not keep_bad:
        notes = notes.where("good")
    arrays = value_arrays(a, cond_idx, length)
    inner = F.lit(length - a.blank3 - a.blank5)

    def numbers(label: str, column: str) -> Column:
        cells = F.transform(F.slice(column, F.lit(a.blank5 + 1), inner), lambda x: F.coalesce(F.format_string("%.4f", x), F.lit("NaN")))
        return F.concat(F.lit(label + ":"), F.col("design_idx").cast("string"), F.lit("\t"), F.array_join(cells, "\t"))

    note_line = F.concat(F.lit("ANNOTATION_DATA:"), F.col("design_idx").cast("string"), F.lit("\t"), F.array_join("annotations", "\t"))
    body = notes.join(arrays, "design_idx").select(
        chunk.cast("bigint").alias("chunk"), "design_idx",
        F.explode(F.array(
            F.struct(F.lit(1).alias("section"), note_line.alias("value")),
            F.struct(F.lit(2).alias("section"), numbers("REACTIVITY", "r").alias("value")),
            F.struct(F.lit(3).alias("section"), numbers("REACTIVITY_ERROR", "r_err").alias("value")),
        )).alias("x"),
    ).select("chunk", "x.section", "design_idx", "x.value")
    value = a.norm_val.where(F.col("cond_idx") == cond_idx).select(
        F.concat(F.lit("processing:normalization:value:"), F.format_string("%.4f", "norm_val"))
    ).scalar()
    positions = "\t".join(f"X{i}" for i in range(a.blank5 + 1, length - a.blank3 + 1))
    fixed = ["RDAT_VERSION\t0.34", f"NAME\t{name}", "SEQUENCE\t" + "X" * length, "STRUCTURE\t" + "." * length,
             "OFFSET\t0", "SEQPOS\t" + positions, *[f"COMMENT\t{c}" for c in comments]]
    notes_head = F.concat(F.lit("ANNOTATION\t" + "".join(f"{x}\t" for x in annotations_all)), value,
                          F.lit(f"\tprocessing:foldmark-v{__version__}"))
    head = body.select("chunk").distinct().select(
        "chunk", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("design_idx"),
        F.concat_ws("\n", *[F.lit(x) for x in fixed], notes_head).alias("value"))
    return head.unionByName(body)


def write_entries(lines: DataFrame, path: str) -> None:
    """One folder per chunk: sections in order, designs in order within a section."""
    lines.repartitionByRange("chunk", "section", "design_idx").sortWithinPartitions(
        "chunk", "section", "design_idx"
    ).select("chunk", "value").write.partitionBy("chunk").text(path)


def write_counts_table(counts: DataFrame, path: str) -> None:
    """Sparse counts as Parquet under ``tag=/measure=`` folders.

    Files hold ranges of designs and are sorted, so that a range of designs is
    found by their statistics. A hot tag is split like any other range.
    """
    keys = ["tag", "measure", "design_idx", "pos"]
    cells = counts.select("tag", "measure", F.col("design_idx").cast("bigint"), F.col("pos").cast("int"), F.col("n").cast("bigint"))
    cells.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("tag", "measure").parquet(path)


def read_counts_table(spark: SparkSession, path: str, tags: list[str] | None = None, measures: list[str] | None = None,
                      first: int | None = None, last: int | None = None) -> DataFrame:
    """Counts of ``write_counts_table``; tags and measures choose folders, a design range prunes row groups."""
    counts = spark.read.schema("design_idx bigint, pos int, n bigint, tag string, measure string").parquet(path)
    for column, wanted in (("tag", tags), ("measure", measures)):
        if wanted is not None:
            counts = counts.where(F.col(column).isin(wanted))
    if first is not None:
        counts = counts.where(F.col("design_idx") >= first)
    if last is not None:
        counts = counts.where(F.col("design_idx") <= last)
    return counts.select("design_idx", "pos", "tag", "measure", "n")
