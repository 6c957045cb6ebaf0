"""Options that change what a reactivity analysis computes."""

from __future__ import annotations

from dataclasses import dataclass

from .fixed_values import MISMATCHES


@dataclass(frozen=True)
class Condition:
    """A treated experiment and, optionally, its untreated control."""

    cond_idx: int
    treated: str
    control: str | None = None

    @property
    def name(self) -> str:
        return self.treated


@dataclass(frozen=True)
class ReactivityOptions:
    spread_deletions: bool = True
    separate_tracks: bool = False
    normalize: bool = True
    focus_on_conditions: bool = False
    no_GA: bool = False
    only_GA: bool = False
    only_AG: bool = False
    totals_only: bool = False

    @property
    def mismatches(self) -> tuple[str, ...]:
        """Mismatch types that count; no_GA wins over only_GA wins over only_AG."""
        if self.no_GA:
            return tuple(t for t in MISMATCHES if t != "GA")
        if self.only_GA:
            return ("GA",)
        if self.only_AG:
            return ("AG",)
        return MISMATCHES

    @property
    def counts_deletions(self) -> bool:
        return self.no_GA or not (self.only_GA or self.only_AG)

    @property
    def only_base(self) -> str | None:
        """Nucleotide outside which values are missing, if restricted."""
        if self.counts_deletions:
            return None
        return "G" if self.only_GA else "A"


def conditions_for(pairs, tags=()) -> list[Condition]:
    """Number the condition list; an empty one makes every tag a condition."""
    pairs = list(pairs) or [(t,) for t in tags]
    return [Condition(i, *pair) for i, pair in enumerate(pairs, start=1)]
