"""Arrow batches of texts, cut into slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one vectorized step works on.
SLICE_BYTES = 4 << 20


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id (as a long) and the text (null: empty), under fixed names, whatever else the table holds."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch in slices of at most ``most`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        pa.default_memory_pool().release_unused()
        ends = offsets(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of an array of strings or binaries without nulls, as 64-bit integers."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, one after another, and their offsets from 0."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = offsets(column)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def raw_texts(column: pa.Array) -> list[bytes]:
    """Each string as its UTF-8 bytes."""
    data, ends = joined_bytes(column)
    view = data.tobytes()
    return [view[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
