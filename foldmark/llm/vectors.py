"""Vector columns: which rows take part, and their Arrow form as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usual_size(df: DataFrame, vector: Column) -> int:
    """The number of components that most vectors have (0: no vectors); of equally frequent ones the larger."""
    sizes = df.groupBy(F.size(vector).alias("size")).count().where("size > 0")
    return sizes.agg(F.max_by("size", F.struct("count", "size"))).first()[0] or 0


def finite(vector: Column, size: int) -> Column:
    """Is the vector there, of the given size, with all components there and finite?"""
    parts = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == size) & parts, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists without nulls as the rows of a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], whole.type)
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(whole), -1) if len(whole) else np.zeros((0, 0), flat.dtype)


def lists(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a column of lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))
