"""Concatenating, combining, averaging and slicing analysed data sets."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import Condition
from ..plans.analysis import Analysis
from . import normalize as N
from .rates import reaggregate_rates
from .signal import signal_to_noise

VALUES = ["r", "r_err", "r_nomod"]


def renormalize(a: Analysis, raw: DataFrame, max_sequences: int | None = None) -> Analysis:
    """Normalize un-normalized reactivity by the set the current coverage picks."""
    chosen = N.normalization_set(N.total_coverage(a.coverage), max_sequences)
    blanked = N.blank_ends(raw, a.blank5, a.blank3, ["r"])
    values = N.norm_values(blanked, chosen)
    columns = [c for c in VALUES if c in raw.columns]
    return replace(a, reactivity=N.normalize(blanked, values, columns).drop("norm_val"), norm_val=values)


def denormalized(a: Analysis) -> DataFrame:
    return N.denormalize(a.reactivity, a.norm_val, [c for c in VALUES if c in a.reactivity.columns])


def concat_designs(sets: list[tuple[Analysis, int]], max_sequences: int | None = None) -> Analysis:
    """Stack data sets along designs; each comes with its number of designs.

    Conditions and tags must agree. Ordinals of later sets are shifted by the
    sizes before them; rates are re-aggregated through counts.
    """
    first = sets[0][0]
    for a, _ in sets:
        if a.conditions != first.conditions or sorted(a.tags) != sorted(first.tags):
            raise ValueError("data sets to concatenate need the same conditions and tags")
    offsets = [sum(n for _, n in sets[:i]) for i in range(len(sets))]

    def stack(frames: list[DataFrame]) -> DataFrame:
        moved = [f.withColumn("design_idx", F.col("design_idx") + F.lit(o).cast("bigint"))
                 for f, o in zip(frames, offsets)]
        return reduce(DataFrame.unionByName, moved)

    members = [a for a, _ in sets]
    rates = None
    if all(a.rates is not None for a in members):
        rates = reaggregate_rates(reduce(DataFrame.unionByName, [a.rates for a in members]), ["pos", "tag", "measure"])
    out = replace(
        first, library=stack([a.library for a in members]), coverage=stack([a.coverage for a in members]),
        reads=stack([a.reads for a in members]), signal_to_noise=stack([a.signal_to_noise for a in members]),
        rates=rates,
    )
    return renormalize(out, stack([denormalized(a) for a in members]), max_sequences)


def unequal_sequences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Designs whose sequences differ between two libraries, or that only one has."""
    x = a.select("design_idx", F.col("sequence").alias("left_sequence"))
    y = b.select("design_idx", F.col("sequence").alias("right_sequence"))
    return x.join(y, "design_idx", "full_outer").where(
        ~F.col("left_sequence").eqNullSafe(F.col("right_sequence"))
    )


def combine_conditions(a: Analysis, b: Analysis, max_sequences: int | None = None) -> Analysis:
    """Append the conditions of ``b``, a data set of the same designs.

    Condition numbers of ``b`` are shifted; coverages of both count. Check the
    libraries with ``unequal_sequences`` first. Signal-to-noise is kept.
    """
    shift = max(c.cond_idx for c in a.conditions)

    def shifted(f: DataFrame) -> DataFrame:
        return f.withColumn("cond_idx", F.col("cond_idx") + F.lit(shift))

    conditions = a.conditions + [replace(c, cond_idx=c.cond_idx + shift) for c in b.conditions]
    out = replace(
        a, conditions=conditions, tags=a.tags + b.tags,
        coverage=a.coverage.unionByName(b.coverage), reads=a.reads.unionByName(shifted(b.reads)),
        signal_to_noise=a.signal_to_noise.unionByName(shifted(b.signal_to_noise)),
        rates=a.rates.unionByName(b.rates) if a.rates is not None and b.rates is not None else None,
    )
    return renormalize(out, denormalized(a).unionByName(shifted(denormalized(b))), max_sequences)


def weighted_mean(rows: DataFrame, by: list[str]) -> DataFrame:
    """Inverse-variance weighted mean of r, leaving out missing values."""
    err = F.col("r_err").cast("double")
    weight = F.try_divide(F.lit(1.0), err * err)
    return rows.groupBy(*by).agg(
        F.sum(F.try_divide(F.col("r"), err * err)).alias("_rw"), F.sum(weight).alias("_w")
    ).select(
        *by, F.try_divide("_rw", "_w").alias("r"), F.sqrt(F.try_divide(F.lit(1.0), F.col("_w"))).alias("r_err")
    )


def _map_column(column: str, mapping: dict) -> Column:
    """Literal lookup of the few conditions or tags the caller grouped."""
    items = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.element_at(F.create_map(*items), F.col(column))


def merge_conditions(a: Analysis, groups: list[list[int]], max_sequences: int | None = None,
                     renorm: bool = True) -> Analysis:
    """Average groups of conditions; names are joined by ``_``, reads and coverage add.

    Controls must be all present or all absent within a group. With ``renorm``
    the average is over un-normalized values and signal-to-noise is
    recomputed; without, normalized values and norm values are averaged.
    """
    by_idx = {c.cond_idx: c for c in a.conditions}
    to_group, tag_groups, conditions = {}, {}, []
    for g, members in enumerate(groups, start=1):
        chosen = [by_idx[i] for i in members]
        if len({c.control is None for c in chosen}) > 1:
            raise ValueError("controls must be given for all or none of the merged conditions")
        treated = "_".join(c.treated for c in chosen)
        control = "_".join(c.control for c in chosen) if chosen[0].control is not None else None
        conditions.append(Condition(g, treated, control))
        to_group |= {i: g for i in members}
        tag_groups.setdefault(treated, []).extend(c.treated for c in chosen)
        if control is not None:
            tag_groups.setdefault(control, []).extend(c.control for c in chosen)
    spark = a.reactivity.sparkSession
    tag_map = F.broadcast(spark.createDataFrame(
        [(t, name) for name, ts in tag_groups.items() for t in ts], "tag string, merged string"
    ))
    regroup = _map_column("cond_idx", to_group)

    def grouped(f: DataFrame) -> DataFrame:
        return f.withColumn("cond_idx", regroup).where(F.col("cond_idx").isNotNull())

    def retagged(f: DataFrame) -> DataFrame:
        return f.join(tag_map, "tag").drop("tag").withColumnRenamed("merged", "tag")

    coverage = retagged(a.coverage).groupBy("design_idx", "tag").agg(F.sum("coverage").alias("coverage"))
    reads = grouped(a.reads).groupBy("design_idx", "cond_idx").agg(F.sum("reads").alias("reads"))
    rates = None if a.rates is None else reaggregate_rates(retagged(a.rates), ["pos", "tag", "measure"])
    keys = ["design_idx", "pos", "base", "seq_len", "cond_idx"]
    mean = weighted_mean(grouped(denormalized(a) if renorm else a.reactivity), keys)
    out = replace(a, conditions=conditions, tags=list(tag_groups), coverage=coverage, reads=reads, rates=rates)
    if renorm:
        out = renormalize(out, mean, max_sequences)
    else:
        values = grouped(a.norm_val).groupBy("cond_idx").agg(F.avg("norm_val").alias("norm_val"))
        out = replace(out, reactivity=mean, norm_val=values)
    return replace(out, signal_to_noise=signal_to_noise(out.reactivity, None, a.blank5, a.blank3))


def slice_designs(a: Analysis, chosen: DataFrame, max_sequences: int | None = None) -> Analysis:
    """Keep the designs of ``chosen`` (design_idx) and renormalize on them."""

    def cut(f: DataFrame) -> DataFrame:
        return f.join(chosen.select("design_idx"), "design_idx", "left_semi")

    out = replace(a, library=cut(a.library), coverage=cut(a.coverage), reads=cut(a.reads),
                  signal_to_noise=cut(a.signal_to_noise))
    return renormalize(out, cut(denormalized(a)), max_sequences)
