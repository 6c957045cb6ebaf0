"""Homopolymer runs and the redistribution of ambiguous deletions within them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import tasks_for
from .reactivity import sq


def homopolymer_runs(library: DataFrame) -> DataFrame:
    """One row per maximal same-nucleotide run: design_idx, base, run_start, run_end, run_len.

    Runs are found inside the design's own row, by comparing each letter with
    the next, so nothing is shuffled. A seq_len column of the library is kept.
    """
    keep = [c for c in ("seq_len",) if c in library.columns]
    letters = library.where(F.length("sequence") > 0).select("design_idx", *keep, F.split("sequence", "").alias("_a"))
    a = F.col("_a")
    ends = letters.select("design_idx", *keep, "_a", F.filter(
        F.sequence(F.lit(1), F.size(a)), lambda i: ~F.get(a, i - 1).eqNullSafe(F.get(a, i))
    ).alias("_ends"))
    runs = F.transform("_ends", lambda end, k: F.struct(
        F.get(a, end - 1).alias("base"),
        (F.coalesce(F.get(F.col("_ends"), k - 1), F.lit(0)) + 1).alias("run_start"), end.alias("run_end"),
    ))
    return ends.select("design_idx", *keep, F.explode(runs).alias("x")).select(
        "design_idx", "x.*", (F.col("x.run_end") - F.col("x.run_start") + 1).alias("run_len"), *keep
    )


def library_positions(library: DataFrame) -> DataFrame:
    """Every position of every design with its base and its run."""
    runs = homopolymer_runs(library)
    return runs.withColumn("pos", F.explode(F.sequence("run_start", "run_end"))).drop("run_start")


def spread_deletions(profiles: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Share the deletions recorded at each run's 3' end over the run.

    Input: rows (design_idx, pos, cond_idx, run_end, run_len, strict,
    strict_err, del, del_err), one per position of each run. The 3' value is
    shared in proportion to the positive part of the strict-mismatch profile,
    or evenly where that is zero throughout; values recorded earlier in a run
    stay where they are. Sums over a run do not change. They are taken from its
    3' end on, so that the same rows give the same last digits every time.
    """
    run = Window.partitionBy("design_idx", "cond_idx", "run_end").orderBy(F.desc("pos")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.col("pos") == F.col("run_end")
    rows = profiles.withColumns({
        "_w": F.greatest(F.col("strict"), F.lit(0.0)),
        "_last": last,
    }).withColumns({
        "_sw": F.sum("_w").over(run),
        "_d": F.max(F.when(F.col("_last"), F.col("del"))).over(run),
        "_e": F.max(F.when(F.col("_last"), F.col("del_err"))).over(run),
    })
    share = F.when(F.col("_sw") > 0, F.try_divide(F.col("_w"), F.col("_sw"))).otherwise(
        F.lit(1.0) / F.col("run_len")
    )
    share_err = F.when(
        F.col("_sw") > 0, F.try_divide(F.col("strict_err") * (1 - share), F.col("_sw"))
    ).otherwise(F.lit(0.0))
    stay = F.when(F.col("_last"), F.lit(0.0)).otherwise(F.col("del"))
    stay_err = F.when(F.col("_last"), F.lit(0.0)).otherwise(F.col("del_err"))
    changed = {
        "del": stay + F.col("_d") * share,
        "del_err": F.sqrt(sq(stay_err) + F.col("_e") * share * F.col("_e") * share
                          + F.col("_d") * share_err * F.col("_d") * share_err),
    }
    return rows.withColumns(changed).drop("_w", "_last", "_sw", "_d", "_e")


def grid_tasks(library: DataFrame, cond_idx: list[int]) -> int:
    """Tasks for every library position and condition; one number is read from the library."""
    letters = library.agg(F.sum(F.length("sequence"))).first()[0] or 0
    return tasks_for(library.sparkSession, letters * len(cond_idx))


def condition_grid(library: DataFrame, cond_idx: list[int], tasks: int | None = None) -> DataFrame:
    """Every library position for every condition; the condition list is a handful of literals.

    Designs are dealt out while each is one short row: a library file is small
    beside what becomes of it, and is often read by one task. The number of
    tasks is stated, as few bytes would be coalesced; by default it follows
    from the library's letters.
    """
    tasks = tasks or grid_tasks(library, cond_idx)
    return library_positions(library.repartition(tasks, "design_idx")).withColumn("cond_idx", F.explode(F.array(*[F.lit(i) for i in cond_idx])))


def on_library(profiles: DataFrame, library: DataFrame, cond_idx: list[int]) -> DataFrame:
    """Lay sparse profiles over every library position and condition.

    Positions without coverage become rows with missing values, which a run
    needs in full.
    """
    return condition_grid(library, cond_idx).join(profiles, ["design_idx", "pos", "cond_idx"], "left")
