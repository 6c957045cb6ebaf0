"""Summaries: per tag, per condition, read funnel, quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordinals import dense_ordinal, median
from .signal import classify_signal

UNITS = ("", "k", "M", "B", "T")


def _spread_of(df: DataFrame, by: str, value: str) -> DataFrame:
    """Sum, mean, floor of the exact median, and their ratio, of a design-level value."""
    sums = df.groupBy(by).agg(F.sum(value).alias("reads"), F.count(F.lit(1)).alias("_t"))
    mean, mid = F.col("reads") / F.col("_t"), F.col("_mid")
    return sums.join(median(df, [by], value, "_mid"), by, "left").select(
        by, "reads", mean.alias("mean_reads"), F.floor(mid).cast("bigint").alias("median_reads"),
        F.try_divide(mean, mid).alias("mean_to_median"),
    )


def tag_stats(coverage: DataFrame) -> DataFrame:
    """Reads of each tag; ``coverage`` has a row for every design and tag."""
    return _spread_of(coverage, "tag", "coverage")


def dense_design_values(library: DataFrame, values: DataFrame, key: str, keys: list, column: str) -> DataFrame:
    """A row for every design and key; designs without a value get zero."""
    grid = library.select("design_idx").withColumn(key, F.explode(F.array(*[F.lit(k) for k in keys])))
    return grid.join(values, ["design_idx", key], "left").select(
        "design_idx", key, F.coalesce(column, F.lit(0)).alias(column)
    )


def condition_stats(reads: DataFrame, reactivity: DataFrame, sn: DataFrame, norm_val: DataFrame) -> DataFrame:
    """Per condition: read statistics, reactivity level and signal-to-noise.

    ``reads`` and ``sn`` are dense over designs; ``reactivity`` holds blanked,
    normalized r. The share of designs with signal-to-noise above 1 counts
    against all designs.
    """
    read_part = _spread_of(reads, "cond_idx", "reads")
    good = sn.where(F.col("signal_to_noise") > 1.0).select("design_idx", "cond_idx")
    level = reactivity.groupBy("cond_idx").agg(F.avg("r").alias("_r"))
    of_good = reactivity.join(good, ["design_idx", "cond_idx"], "left_semi")
    middle = median(of_good, ["cond_idx"], "r", "median_norm")
    quality = sn.groupBy("cond_idx").agg(
        F.avg("signal_to_noise").alias("mean_sn"),
        F.avg((F.col("signal_to_noise") > 1.0).cast("int")).alias("frac_sn1"),
    )
    parts = [norm_val, level, middle, quality]
    out = reduce(lambda a, b: a.join(b, "cond_idx", "left"), parts, read_part)
    return out.withColumn("mean_react", F.col("_r") * F.col("norm_val")).drop("_r")


def human_readable(x: Column) -> Column:
    """Thousands-based short form with one decimal: 1.2k, 3.4M.

    The double itself is rounded, as C's printf does, with exact halves to even;
    Spark's own format rounds the shortest decimal text of it, halves up.
    """
    power = sum((F.when(x >= F.lit(1000.0 ** k), 1).otherwise(0) for k in range(1, 5)), F.lit(0))
    scaled = F.abs(x / F.element_at(F.array(*[F.lit(1000.0 ** k) for k in range(5)]), power + 1))
    unit = F.element_at(F.array(*[F.lit(u) for u in UNITS]), power + 1)
    # The fraction of a double from 1 on is a whole number of 2**-52, so ten times it fits a bigint.
    one = 1 << 52
    ten = ((scaled - F.floor(scaled)) * F.lit(float(one))).cast("bigint") * 10
    digit, rest = F.shiftright(ten, 52), ten.bitwiseAND(one - 1)
    up = (rest > one // 2) | ((rest == one // 2) & (digit % 2 == 1))
    tenths = F.floor(scaled).cast("bigint") * 10 + digit + up.cast("bigint")
    text = F.concat(F.when(x < 0, "-").otherwise(""), F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("string"))
    return F.when(x == 0, "0").otherwise(F.concat(text, unit))


def funnel(stages: DataFrame) -> DataFrame:
    """Percent of the previous stage, over (stage_no, stage, n_reads) with reads.

    There are as many rows as stages of a run.
    """
    w = Window.orderBy("stage_no")
    return stages.where(F.col("n_reads") > 0).select(
        "stage_no", "stage", "n_reads",
        F.try_divide(F.lit(100.0) * F.col("n_reads"), F.lag("n_reads").over(w)).alias("percent"),
    )


def overall_yield(stages: DataFrame) -> DataFrame:
    """Smallest over largest stage, in percent."""
    return stages.where(F.col("n_reads") > 0).agg(
        F.min("n_reads").alias("least"), F.max("n_reads").alias("most"),
        F.try_divide(F.lit(100.0) * F.min("n_reads"), F.max("n_reads")).alias("percent"),
    )


def quality_pass(sn: DataFrame, reads: DataFrame, sn_cutoff: float = 1.0, reads_cutoff: int = 100,
                 strict_reads: bool = False) -> DataFrame:
    """(design_idx, cond_idx, signal_to_noise, reads, passes) of the quality filter."""
    enough = F.col("reads") > reads_cutoff if strict_reads else F.col("reads") >= reads_cutoff
    return sn.join(reads, ["design_idx", "cond_idx"]).withColumn(
        "passes", (F.col("signal_to_noise") >= sn_cutoff) & enough
    )


def pass_rate(quality: DataFrame) -> DataFrame:
    return quality.groupBy("cond_idx").agg(
        F.count_if("passes").alias("passing"), F.count("*").alias("designs"),
        (F.lit(100.0) * F.avg(F.col("passes").cast("int"))).alias("percent"),
    )


def signal_histogram(sn: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Designs per signal-to-noise bin; missing counts as zero, ends are open."""
    value = F.coalesce("signal_to_noise", F.lit(0.0))
    bin_no = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)).cast("int")
    return sn.groupBy("cond_idx", bin_no.alias("bin")).agg(F.count("*").alias("designs"))


def best_design(sn: DataFrame) -> DataFrame:
    """Design with the largest summed signal-to-noise; the first one on a tie."""
    sums = sn.groupBy("design_idx").agg(F.sum("signal_to_noise").alias("total"))
    return sums.orderBy(F.desc("total"), "design_idx").limit(1)


def numbered_designs(df: DataFrame) -> DataFrame:
    """All rows with their ordinal in library order, from which a listing takes as many as it shows."""
    return dense_ordinal(df, "design_idx", "ordinal")


def heatmap_designs(quality: DataFrame, cond_idx: int) -> DataFrame:
    """(design_idx, ordinal) of a condition's passing designs; ``quality`` uses the strict reads test."""
    good = quality.where((F.col("cond_idx") == cond_idx) & F.col("passes")).select("design_idx")
    return numbered_designs(good)


def quality_labels(quality: DataFrame) -> DataFrame:
    return quality.withColumn("signal_class", classify_signal(F.col("signal_to_noise")))


def run_review(files: DataFrame) -> DataFrame:
    """Flags per run directory from its files (directory, file, size): run.out and run.err.

    Sizes are aggregated per directory; a directory is a problem when it has no
    output file, an empty one, or a non-empty error file.
    """
    out, err = F.col("file") == "run.out", F.col("file") == "run.err"
    return files.groupBy("directory").agg(
        (F.count_if(out) == 0).alias("no_run"),
        (F.coalesce(F.max(F.when(err, F.col("size"))), F.lit(0)) > 0).alias("has_error"),
        (F.coalesce(F.max(F.when(out, F.col("size"))), F.lit(1)) == 0).alias("empty_out"),
    ).withColumn("problem", F.col("no_run") | F.col("has_error") | F.col("empty_out"))


def review_counts(review: DataFrame) -> DataFrame:
    return review.agg(
        F.count("*").alias("directories"), F.count_if(~F.col("no_run")).alias("with_run"),
        F.count_if("no_run").alias("without_run"), F.count_if("has_error").alias("with_error"),
        F.count_if("empty_out").alias("with_empty_out"), F.count_if("problem").alias("problems"),
    )
