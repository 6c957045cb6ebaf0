"""Counts to normalized reactivity: the whole second half of an experiment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import Condition, ReactivityOptions
from ..operators import joins as J
from ..operators import normalize as N
from ..operators import rates as T
from ..operators import reactivity as R
from ..operators import spread as S
from ..operators.signal import signal_to_noise
from ..session import written


def reactivity(counts: DataFrame, library: DataFrame, conditions: list[Condition],
               options: ReactivityOptions = ReactivityOptions(), tasks: int | None = None) -> DataFrame:
    """Background-subtracted reactivity at every library position and condition.

    ``library`` has design_idx and sequence. Designs are independent,
    so restricting ``counts`` and ``library`` to some designs gives exactly
    their part of the result. With ``totals_only`` the counter's own totals
    (measure ``muts``) are all that is used. Without ``tasks`` the library's
    letters are added up first, to deal its positions out into enough of them.
    """
    cond_idx = [c.cond_idx for c in conditions]
    tasks = tasks or S.grid_tasks(library, cond_idx)
    places = S.condition_grid(with_length(library), cond_idx, tasks)
    if options.totals_only:
        totals = R.legacy_reactivity(counts, conditions, tasks=tasks)
        return places.drop("run_end", "run_len").join(totals, ["design_idx", "pos", "cond_idx"], "left")
    grid = R.subtract_background(counts, conditions, options, places, tasks)
    tracks = [t for t in ("to_A", "to_C", "to_G", "to_T", "ins") if options.separate_tracks]
    grid = R.restrict_base(grid, options.only_base, ["strict", "strict_err", "del", "del_err", "r_nomod", *tracks])
    if options.spread_deletions:
        grid = S.spread_deletions(grid)
    extra = ["base", "seq_len", *tracks] + (["del"] if options.separate_tracks else [])
    return R.combine_profiles(grid, extra)


def _sampled_reactivity(counts, library, conditions, options, chosen) -> DataFrame:
    """Reactivity of a bounded normalization set only, whose counts alone are read."""
    few = F.broadcast(chosen.select("design_idx"))  # fewer than 2 * max_sequences rows by construction
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reactivity(counts.join(few, "design_idx", "left_semi"), library.join(few, "design_idx", "left_semi"),
                      conditions, options, tasks)


def normalize_by_nucleotide(counts: DataFrame, library: DataFrame, conditions: list[Condition],
                            options: ReactivityOptions = ReactivityOptions(), blank5: int = 0, blank3: int = 0,
                            max_norm_sequences: int | None = None) -> DataFrame:
    """Reactivity divided by a separate 90th percentile for each nucleotide; computed once and written."""
    library = with_length(library)
    chosen = N.normalization_set(N.total_coverage(N.coverage_by_tag(counts)), max_norm_sequences)
    r = written(reactivity(counts, library, conditions, options), "reactivity")
    values = N.norm_values(N.blank_ends(r, blank5, blank3, ["r"]), chosen, by=("cond_idx", "base"))
    return N.normalize(r, values, ["r", "r_err"], by=("cond_idx", "base")).drop("norm_val")


@dataclass
class Analysis:
    """The tables of one analysed experiment.

    ``rates`` are mutation rates by position, tag and measure; ``norm_cutoff``
    is one row with the coverage that designs of the normalization set exceed.
    """

    library: DataFrame
    conditions: list[Condition]
    reactivity: DataFrame
    norm_val: DataFrame
    coverage: DataFrame
    reads: DataFrame
    signal_to_noise: DataFrame
    rates: DataFrame | None = None
    norm_cutoff: DataFrame | None = None
    blank5: int = 0
    blank3: int = 0
    tags: list[str] = field(default_factory=list)


def with_length(library: DataFrame) -> DataFrame:
    return library if "seq_len" in library.columns else library.withColumn("seq_len", F.length("sequence"))


def reads_per_condition(coverage: DataFrame, conditions: list[Condition]) -> DataFrame:
    roles = R.role_table(coverage.sparkSession, conditions)
    return coverage.join(F.broadcast(roles), "tag").groupBy("design_idx", "cond_idx").agg(
        F.sum("coverage").alias("reads")
    )


def constant_ends(library: DataFrame) -> tuple[int, int]:
    """Lengths of the constant ends the library's first design shows; only that sequence reaches the driver."""
    first = library.agg(F.min_by("sequence", "design_idx").alias("s"))
    five, three = N.auto_blank_ends(F.col("s"))
    ends = first.select(five.alias("five"), three.alias("three")).first()
    return ends["five"], ends["three"]


def with_known_tags(counts: DataFrame, conditions: list[Condition], tags: list[str] | None = None) -> DataFrame:
    """The same counts; a plan that reads them fails where a condition's name doesn't match exactly one tag.

    ``tags`` are the experiment's tags, as its barcode file lists them; without
    them, those that have counts. The check is one number inside the plan.
    """
    if tags is None:
        known = counts.select("tag").distinct()
    else:
        known = counts.sparkSession.createDataFrame([(t,) for t in tags], "tag string")
    matched = J.require_tags(known, conditions).agg(F.count("tag").alias("n")).scalar()
    return counts.where(matched > 0)


def analyse(counts: DataFrame, library: DataFrame, conditions: list[Condition],
            options: ReactivityOptions = ReactivityOptions(), blank5: int | None = 0, blank3: int | None = 0,
            max_norm_sequences: int | None = None, tags: list[str] | None = None) -> Analysis:
    """Build the tables of a full analysis.

    Norm values are exact ranks over all designs above the cutoff, taken from
    the same reactivity they divide: it is computed once and written. With
    ``max_norm_sequences`` they come from every stride-th of those designs, and
    the counts are cut down to those before any reactivity is computed for them.

    An end whose length is None is recognised from the first design. A condition that doesn't name exactly one
    tag (of ``tags``, if given) is an error when a table is computed.
    """
    library = with_length(library)
    counts = with_known_tags(counts, conditions, tags)
    if blank5 is None or blank3 is None:
        five, three = constant_ends(library)
        blank5, blank3 = five if blank5 is None else blank5, three if blank3 is None else blank3
    if options.focus_on_conditions:
        used = {c.treated for c in conditions} | {c.control for c in conditions if c.control}
        counts = counts.where(F.col("tag").isin(sorted(used)))
    coverage = N.coverage_by_tag(counts)
    totals = N.total_coverage(coverage)
    chosen = N.normalization_set(totals, max_norm_sequences)
    r = reactivity(counts, library, conditions, options)
    tracks = [t for t in ("to_A", "to_C", "to_G", "to_T", "del", "ins") if t in r.columns]
    blanked = N.blank_ends(r, blank5, blank3, ["r", *tracks])
    if options.normalize:
        blanked = written(blanked, "reactivity")
    if max_norm_sequences is None:
        values = N.norm_values(blanked, chosen)
    else:
        sampled = _sampled_reactivity(counts, library, conditions, options, chosen)
        values = N.norm_values(N.blank_ends(sampled, blank5, blank3, ["r"]))
    normed = (
        N.normalize(blanked, values, ["r", "r_err", "r_nomod", *tracks]).drop("norm_val")
        if options.normalize else blanked
    )
    return Analysis(
        library=library, conditions=conditions, reactivity=normed, norm_val=values, coverage=coverage,
        reads=reads_per_condition(coverage, conditions),
        signal_to_noise=signal_to_noise(blanked, None, blank5, blank3),
        rates=T.rate_matrix(counts), norm_cutoff=N.coverage_cutoff(totals),
        blank5=blank5, blank3=blank3, tags=list(tags or []),
    )
