"""Counts to background-subtracted reactivity with errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MISMATCHES, MUTS, TRACKS
from ..options import Condition, ReactivityOptions

KEYS = ["design_idx", "pos"]


def _n(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))


def ratio(n: Column, c: Column) -> Column:
    """n / c, missing where nothing covers the position."""
    return F.try_divide(n.cast("double"), c.cast("double"))


def sq(x: Column) -> Column:
    return x * x


def mutation_fraction(counts: DataFrame, options: ReactivityOptions = ReactivityOptions()) -> DataFrame:
    """Per design, position and tag: mutated fraction, its error and the error floor.

    The error is the quadrature sum of the Poisson errors sqrt(n)/c of the
    counted types, which is sqrt(sum n)/c; the floor is one count, 1/c.
    """
    types = list(options.mismatches) + (["del"] if options.counts_deletions else [])
    m = F.col("measure")
    agg = counts.where(m.isin(types + [COVERAGE])).groupBy(*KEYS, "tag").agg(
        _n(m.isin(types)).alias("n"), _n(m == COVERAGE).alias("c")
    )
    return agg.select(
        *KEYS, "tag",
        ratio(F.col("n"), F.col("c")).alias("f"),
        F.try_divide(F.sqrt(F.col("n").cast("double")), F.col("c").cast("double")).alias("f_err"),
        F.try_divide(F.lit(1.0), F.col("c").cast("double")).alias("f_floor"),
    )


def role_table(spark: SparkSession, conditions: list[Condition]) -> DataFrame:
    """(tag, cond_idx, treated): which conditions a tag serves, and how."""
    rows = [(c.treated, c.cond_idx, True) for c in conditions]
    rows += [(c.control, c.cond_idx, False) for c in conditions if c.control is not None]
    return spark.createDataFrame(rows, "tag string, cond_idx int, treated boolean")


def pair_counts(counts: DataFrame, conditions: list[Condition], sums: dict[str, list[str]],
                grid: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Sums of each condition's treated (``_s``) and control (``_n``) counts.

    ``sums`` names the measures added up in each output column. Treated and
    control rows meet in one aggregation, so no self join is needed; the role
    table has two rows per condition the caller listed.

    With a ``grid`` of (design_idx, pos, cond_idx) and further columns, the
    result has exactly its rows and those columns. Grid rows go through the
    same aggregation, which is cheaper than joining them to its result.

    Rows are dealt out by design and condition into a stated number of tasks
    before they are summed: as good as every cell is new to a file's share of
    them, so sums per file would hold them all in memory. A design's rows are
    bounded by its length, and what groups by its runs needs no other shuffle.
    By default it is the session's number, which does not follow the rows; who
    knows how many counts there are names it.
    """
    used = sorted({x for names in sums.values() for x in names})
    roles = role_table(counts.sparkSession, conditions)
    rows = counts.where(F.col("measure").isin(used)).join(F.broadcast(roles), "tag").select(
        *KEYS, "cond_idx", "measure", "treated", "n"
    )
    extra = {}
    if grid is not None:
        types = dict(grid.dtypes)
        extra = {c: types[c] for c in grid.columns if c not in (*KEYS, "cond_idx")}
        # single letters travel as numbers, which hash aggregation can take the maximum of
        coded = grid.withColumns({c: F.ascii(c) for c, t in extra.items() if t == "string"})
        rows = rows.unionByName(coded, allowMissingColumns=True)
    m, treated = F.col("measure"), F.col("treated")
    cols = [F.max(c).alias(c) for c in extra]
    for name, names in sums.items():
        cols.append(_n(treated & m.isin(names)).alias(f"{name}_s"))
        cols.append(_n(~treated & m.isin(names)).alias(f"{name}_n"))
    tasks = tasks or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = rows.repartition(tasks, "design_idx", "cond_idx").groupBy(*KEYS, "cond_idx").agg(*cols)
    if grid is not None:
        out = out.where(F.col(next(iter(extra))).isNotNull()).withColumns(
            {c: F.char(c) for c, t in extra.items() if t == "string"}
        )
    return out


def _has_control(conditions: list[Condition]) -> Column:
    return F.col("cond_idx").isin([c.cond_idx for c in conditions if c.control is not None])


def _subtract(name: str, control: Column) -> Column:
    treated = ratio(F.col(f"{name}_s"), F.col("c_s"))
    return F.when(control, treated - ratio(F.col(f"{name}_n"), F.col("c_n"))).otherwise(treated)


def _variance(n: str, control: Column) -> Column:
    """Poisson variance n/c^2 of the treated, plus that of the control."""
    treated = F.try_divide(F.col(f"{n}_s").cast("double"), sq(F.col("c_s").cast("double")))
    background = F.try_divide(F.col(f"{n}_n").cast("double"), sq(F.col("c_n").cast("double")))
    return F.when(control, treated + background).otherwise(treated)


def subtract_background(counts: DataFrame, conditions: list[Condition],
                        options: ReactivityOptions = ReactivityOptions(), grid: DataFrame | None = None,
                        tasks: int | None = None) -> DataFrame:
    """Strict-mismatch and deletion profiles per condition, with errors.

    Columns: strict, strict_err, del, del_err, floor_err (one count in each
    channel), r_nomod, and the separate tracks when asked for. Positions the
    treated experiment does not cover have no row; where only the control is
    missing the values are. With a ``grid`` (see ``pair_counts``) every one of
    its positions has a row.
    """
    strict = list(options.mismatches)
    dels = ["del"] if options.counts_deletions else []
    sums = {"strict": strict, "del": dels, "c": [COVERAGE]}
    if options.separate_tracks:
        sums |= {f"t_{t}": list(types) for t, types in TRACKS.items() if t != "del"}
    pairs = pair_counts(counts, conditions, sums, grid, tasks)
    if grid is None:
        pairs = pairs.where(F.col("c_s") > 0)
    kept = [] if grid is None else [c for c in grid.columns if c not in (*KEYS, "cond_idx")]
    control = _has_control(conditions)
    one_s, one_n = (F.try_divide(F.lit(1.0), sq(F.col(c).cast("double"))) for c in ("c_s", "c_n"))
    tracks = [
        _subtract(f"t_{t}", control).alias(t)
        for t in TRACKS if options.separate_tracks and t != "del"
    ]
    nomod = ratio(F.col("strict_n") + F.col("del_n"), F.col("c_n"))
    return pairs.select(
        *KEYS, "cond_idx", *kept,
        _subtract("strict", control).alias("strict"),
        F.sqrt(_variance("strict", control)).alias("strict_err"),
        _subtract("del", control).alias("del"),
        F.sqrt(_variance("del", control)).alias("del_err"),
        F.sqrt(F.when(control, one_s + one_n).otherwise(one_s)).alias("floor_err"),
        F.when(F.col("c_s") > 0, F.when(control, nomod).otherwise(F.lit(0.0))).alias("r_nomod"),
        *tracks,
    )


def combine_profiles(profiles: DataFrame, extra: list[str] = ()) -> DataFrame:
    """r = strict + del; errors add in quadrature, with the one-count floor."""
    return profiles.select(
        *KEYS, "cond_idx", *extra,
        (F.col("strict") + F.col("del")).alias("r"),
        F.sqrt(sq(F.col("strict_err")) + sq(F.col("del_err")) + sq(F.col("floor_err"))).alias("r_err"),
        "r_nomod",
    )


def restrict_base(profiles: DataFrame, base: str | None, columns: list[str]) -> DataFrame:
    """Missing values where the design's nucleotide is not ``base``."""
    if base is None:
        return profiles
    return profiles.withColumns(
        {c: F.when(F.col("base") == base, F.col(c)) for c in columns}
    )


def legacy_reactivity(counts: DataFrame, conditions: list[Condition],
                      control_error_scale: float = 0.0, tasks: int | None = None) -> DataFrame:
    """Reactivity from total mutation counts only: (m/c) differences, errors sqrt(m+1)/c."""
    pairs = pair_counts(counts, conditions, {"m": [MUTS], "c": [COVERAGE]}, tasks=tasks).where(F.col("c_s") > 0)
    control = _has_control(conditions)

    def err2(side: str) -> Column:
        return F.try_divide((F.col(f"m_{side}") + 1).cast("double"), sq(F.col(f"c_{side}").cast("double")))

    f_n = ratio(F.col("m_n"), F.col("c_n"))
    return pairs.select(
        *KEYS, "cond_idx",
        _subtract("m", control).alias("r"),
        F.sqrt(
            F.when(control, err2("s") + err2("n") + sq(F.lit(control_error_scale) * f_n)).otherwise(err2("s"))
        ).alias("r_err"),
        F.when(control, f_n).otherwise(F.lit(0.0)).alias("r_nomod"),
    )



def type_fractions(counts: DataFrame) -> DataFrame:
    """Per mutation type: n/c and its Poisson error sqrt(n)/c.

    Coverage is attached by a window over (design, position, tag), whose
    partitions hold at most one row per measure.
    """
    cell = Window.partitionBy(*KEYS, "tag")
    c = F.max(F.when(F.col("measure") == COVERAGE, F.col("n"))).over(cell)
    rows = counts.where(F.col("measure") != MUTS).withColumn("_c", c).where(F.col("measure") != COVERAGE)
    return rows.select(
        *KEYS, "tag", "measure",
        ratio(F.col("n"), F.col("_c")).alias("frc"),
        F.try_divide(F.sqrt(F.col("n").cast("double")), F.col("_c").cast("double")).alias("frc_err"),
    )


def quadrature_sum(column: str) -> Column:
    return F.sqrt(F.sum(sq(F.col(column))))


def with_muts(counts: DataFrame) -> DataFrame:
    """Add the total mutation count (mismatches and deletions) as a measure."""
    muts = counts.where(F.col("measure").isin([*MISMATCHES, "del"])).groupBy(*KEYS, "tag").agg(
        F.sum("n").alias("n")
    ).withColumn("measure", F.lit(MUTS))
    return counts.unionByName(muts)


def condition_labels(tags: DataFrame, conditions: list[Condition]) -> DataFrame:
    """A condition is labelled with the tag of its treated experiment."""
    treated = role_table(tags.sparkSession, conditions).where("treated")
    return tags.join(F.broadcast(treated), "tag").select("cond_idx", F.col("tag").alias("condition"))
