"""Merging overlapping mates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import reverse_complement


def _overlaps(left: pd.Series, right: pd.Series, least: int, rate: float) -> np.ndarray:
    """Longest overlap of each left end with its right start within the mismatch rate, 0 if none.

    Pairs of equal lengths are compared together, one overlap length after
    another, until none is open.
    """
    out = np.zeros(len(left), np.int32)
    sizes = left.str.len().to_numpy() * (1 << 32) + right.str.len().to_numpy()
    for both in np.unique(sizes):
        rows = np.flatnonzero(sizes == both)
        n, m = int(both) >> 32, int(both) & 0xFFFFFFFF
        a = np.frombuffer("".join(left.iloc[rows]).encode("latin-1"), np.uint8).reshape(len(rows), n)
        b = np.frombuffer("".join(right.iloc[rows]).encode("latin-1"), np.uint8).reshape(len(rows), m)
        open_ = np.arange(len(rows))
        for k in range(min(n, m), least - 1, -1):
            fits = np.count_nonzero(a[open_, n - k :] != b[open_, :k], axis=1) <= rate * k
            out[rows[open_[fits]]] = k
            open_ = open_[~fits]
            if not len(open_):
                break
    return out


def _overlap_column(least: int, rate: float):
    @F.pandas_udf("int")
    def overlap(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(_overlaps(left, right, least, rate))

    return overlap


def merge_pairs(mates1: DataFrame, mates2: DataFrame, min_overlap: int = 12, mismatch_rate: float = 0.1) -> DataFrame:
    """One row per read pair: merged sequence, or both mates unmerged when they do not overlap.

    Mates meet by read id, which is unique. Where they disagree the second
    mate's quality decides if it is higher.
    """
    right = mates2.select("read_id", reverse_complement(F.col("seq")).alias("seq2"), F.reverse("qual").alias("qual2"))
    pairs = mates1.join(right, "read_id").withColumn(
        "overlap", _overlap_column(min_overlap, mismatch_rate)("seq", "seq2")
    )
    n, start = F.col("overlap"), F.length("seq") - F.col("overlap")
    end1, end2 = F.substring("seq", start + 1, n), F.substring("seq2", F.lit(1), n)
    q1, q2 = F.substring("qual", start + 1, n), F.substring("qual2", F.lit(1), n)

    def choose(x, y, best_of):
        picked = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.when(
            F.substring(q2, i, F.lit(1)) > F.substring(q1, i, F.lit(1)), F.substring(y, i, F.lit(1))
        ).otherwise(F.substring(x, i, F.lit(1))))
        return F.when(best_of, x).otherwise(F.array_join(picked, ""))

    agree = end1 == end2
    body = F.concat(F.substring("seq", F.lit(1), start), choose(end1, end2, agree), F.substring("seq2", n + 1, F.length("seq2")))
    qual = F.concat(F.substring("qual", F.lit(1), start), choose(q1, q2, F.lit(False)), F.substring("qual2", n + 1, F.length("qual2")))
    merged = n > 0
    return pairs.select(
        "read_id", merged.alias("merged"), "overlap",
        F.when(merged, body).otherwise(F.col("seq")).alias("seq"),
        F.when(merged, qual).otherwise(F.col("qual")).alias("qual"),
        F.when(~merged, F.col("seq2")).alias("mate_seq"), F.when(~merged, F.col("qual2")).alias("mate_qual"),
    )
