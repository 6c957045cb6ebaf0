"""Dense ordinals and exact ranks without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# monotonically_increasing_id holds the partition above this bit, the row's place in it below.
_PLACE_BITS = 33


def dense_ordinal(df: DataFrame, key: str, name: str, bucket: int | None = None) -> DataFrame:
    """Number rows 1..n in the order of a unique integer ``key``, however sparse its values are.

    Rows are range-partitioned by the key, sorted inside each partition and
    written once with their place in it. The partitions' sizes are all that
    leaves the tasks (one number per shuffle partition), so no window runs and
    no list of keys meets in one task. With ``bucket``, partitions hold about
    that many rows in place of the session's number of partitions.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket is not None:
        ranges = max(1, -(-df.count() // bucket))
    placed = written(
        df.repartitionByRange(ranges, key).sortWithinPartitions(key).withColumn("_place", F.monotonically_increasing_id()),
        "ordinals",
    ).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    sizes = sorted(placed.groupBy("_part").count().collect())
    starts = [(part, before) for (part, _), before in zip(sizes, accumulate((n for _, n in sizes), initial=0))]
    offsets = F.broadcast(spark.createDataFrame(starts, "_part bigint, _offset bigint"))
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return placed.join(offsets, "_part").withColumn(name, F.col("_offset") + place + 1).drop("_part", "_place", "_offset")


def rank_position(n: Column, num: int = 9, den: int = 10) -> Column:
    """round(num/den * n), halves up, in integers: the nearest-rank position."""
    return F.floor((F.lit(2 * num) * n + F.lit(den)) / F.lit(2 * den)).cast("bigint")


#: Ranges that the distinct values of a group are cut into.
RANGES = 64


def pick_ranks(df: DataFrame, groups: list[str], value: str, picks: list[tuple[Callable[[Column], Column], bool]],
               ranges: int = RANGES) -> DataFrame:
    """Exact k-th smallest values of each group (columns _v0, _v1, ...), for groups of any size.

    A pick is (rank as a function of the number of values, count zeros out?).
    Equal values are counted first; all else works on these counts, whose
    shuffle is done once and reused. A sketch cuts each group's distinct values
    into ranges; one row per range says which one holds a rank, and only those
    are sorted. The sketch's error moves work between ranges, not results: a
    second evaluation of it may cut elsewhere, so a range that holds a rank is
    found again by its own least and largest value, never by the sketch.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    hist = counts.withColumn("_nz", F.when(F.col(value) != 0, F.col("_n")).otherwise(F.lit(0)))
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = hist.groupBy(*groups).agg(
        F.percentile_approx(value, cuts, 20 * ranges).alias("_cuts"), F.sum("_n").alias("_all"), F.sum("_nz").alias("_allz"),
    )
    placed = hist.join(bounds, groups).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    per = placed.groupBy(*groups, "_range").agg(
        F.sum("_n").alias("_rn"), F.sum("_nz").alias("_rz"), F.max("_all").alias("_all"), F.max("_allz").alias("_allz"),
        F.min(value).alias("_least"), F.max(value).alias("_most"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        *groups, "_range", "_rn", "_rz", "_least", "_most", F.coalesce(F.sum("_rn").over(before), F.lit(0)).alias("_bn"),
        F.coalesce(F.sum("_rz").over(before), F.lit(0)).alias("_bz"),
        *[rank(F.col("_allz" if nonzero else "_all")).alias(f"_k{i}") for i, (rank, nonzero) in enumerate(picks)],
    )

    def inside(i: int, nonzero: bool) -> Column:
        k, low = F.col(f"_k{i}"), F.col("_bz" if nonzero else "_bn")
        return (low < k) & (k <= low + F.col("_rz" if nonzero else "_rn"))

    wanted = per.where(reduce(lambda x, y: x | y, [inside(i, z) for i, (_, z) in enumerate(picks)])).drop("_rn", "_rz")
    upto = Window.partitionBy(*groups, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.join(wanted, groups).where(F.col(value).between(F.col("_least"), F.col("_most"))).withColumns({
        "_cn": F.sum("_n").over(upto) + F.col("_bn"), "_cz": F.sum("_nz").over(upto) + F.col("_bz")})

    def at(i: int, nonzero: bool) -> Column:
        upper, own = (F.col("_cz"), F.col("_nz")) if nonzero else (F.col("_cn"), F.col("_n"))
        return F.max(F.when((upper >= F.col(f"_k{i}")) & (upper - own < F.col(f"_k{i}")), F.col(value)))

    return ranked.groupBy(*groups).agg(*[at(i, z).alias(f"_v{i}") for i, (_, z) in enumerate(picks)])


def nearest_rank(df: DataFrame, groups: list[str], value: str, name: str, num: int = 9, den: int = 10) -> DataFrame:
    """Exact nearest-rank quantile of each group; where it is zero, that of the non-zero values."""
    rank = lambda n: rank_position(n, num, den)
    picked = pick_ranks(df, groups, value, [(rank, False), (rank, True)])
    return picked.select(*groups, F.when(F.col("_v0") == 0, F.coalesce("_v1", F.lit(0.0))).otherwise(F.col("_v0")).alias(name))


def median(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """Exact median of each group."""
    mid = pick_ranks(df, groups, value, [(lambda n: F.floor((n + 1) / 2), False), (lambda n: F.floor((n + 2) / 2), False)])
    return mid.select(*groups, ((F.col("_v0") + F.col("_v1")) / F.lit(2.0)).alias(name))
