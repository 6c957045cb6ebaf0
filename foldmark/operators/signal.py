"""Signal-to-noise per design."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify_signal(sn: Column) -> Column:
    """N/A for missing or zero, then weak < 1 <= medium < 5 <= good < 10 <= strong."""
    return (
        F.when(sn.isNull() | (sn == 0), "N/A")
        .when(sn < 1, "weak").when(sn < 5, "medium").when(sn < 10, "good")
        .otherwise("strong")
    )


def signal_to_noise(reactivity: DataFrame, lengths: DataFrame | None, blank5: int, blank3: int,
                    signal: str = "r", noise: str = "r_err") -> DataFrame:
    """mean(signal)/mean(noise) per design and condition, 0 where undefined.

    Good points lie inside the blanked ends, have values and positive noise.
    More than three are needed; the first and the last are left out before
    anything is added up, as taking them off a sum leaves rounding errors where
    nothing should be left. The points of a design and condition, at most one a
    position, are added in order of position. ``lengths`` (design_idx, seq_len)
    is not needed when ``reactivity`` has seq_len.
    """
    rows = reactivity if "seq_len" in reactivity.columns else reactivity.join(lengths, "design_idx")
    good = (
        (F.col("pos") > blank5) & (F.col("pos") <= F.col("seq_len") - blank3)
        & F.col(signal).isNotNull() & (F.col(noise) > 0)
    )
    point = F.when(good, F.struct("pos", F.col(signal).alias("s"), F.col(noise).alias("e")))
    agg = rows.withColumn("_p", point).groupBy("design_idx", "cond_idx").agg(F.sort_array(F.collect_list("_p")).alias("_all"))
    k = F.size("_all")
    inner = F.when(k > 3, F.slice("_all", 2, k - 2))

    def mean(name: str) -> Column:
        return F.aggregate(inner, F.lit(0.0), lambda total, x: total + x[name]) / (k - 2)

    value = F.try_divide(mean("s"), mean("e"))
    return agg.select("design_idx", "cond_idx", F.coalesce(value, F.lit(0.0)).alias("signal_to_noise"))
