"""Byte-level BPE: merges driven by a segment tree that holds the leftmost minimum pair rank."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import joined_bytes, keyed_texts, text_slices

#: Matches up to this many bytes are merged side by side in arrays; longer ones alone.
SIDE_BY_SIDE = 64
#: Encoded matches a worker keeps before it starts anew.
KEPT_MATCHES = 250_000

_NONE = np.int64(1) << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: on each line a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Which two tokens merge into which third: a sorted table over both ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted(
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items() for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks
        )
        self.pairs = np.array([p for p, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.merged = np.array([r for _, r in pairs] + [0], np.int64)
        self.lookup = dict(pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged token, _NONE if there is none. Negative ids stand for no token."""
        wanted = left << 32 | np.maximum(right, 0)
        at = np.searchsorted(self.pairs, wanted)
        return np.where((self.pairs[at] == wanted) & (left >= 0) & (right >= 0), self.merged[at], _NONE)


def merge_one(word: bytes, merges: Merges) -> list[int]:
    """Token ids of one match.

    Leaf i of the tree is the rank of the pair that starts at live byte
    position i (with the position, so the leftmost of equal ranks is least), and
    each node the least of its children. A merge changes the leaves of the
    merged pair, of its live left neighbour, and of the token that is gone.
    """
    n = len(word)
    size = 1 << max(0, (n - 1)).bit_length()
    none = int(_NONE)
    ids = [int(merges.byte_ids[b]) for b in word]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * size)
    lookup = merges.lookup

    def key(i: int, j: int) -> int:
        rank = lookup.get(ids[i] << 32 | ids[j])
        return none if rank is None else rank << 32 | i

    for i in range(n - 1):
        tree[size + i] = key(i, i + 1)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    while n > 1 and tree[1] != none:
        i = tree[1] & 0xFFFFFFFF
        ids[i] = tree[1] >> 32
        gone = after[i]
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, key(i, after[i]) if after[i] < n else none)
        if before[i] >= 0:
            put(before[i], key(before[i], i))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_many(words: list[bytes], merges: Merges) -> list[bytes]:
    """Token ids (little-endian unsigned 32-bit) of many matches of one length class, merged side by side.

    The same tree and updates as in merge_one, one row per match; in every step
    each match that still has a mergeable pair does its leftmost best merge.
    """
    count, n = len(words), max(map(len, words))
    sizes = np.fromiter(map(len, words), np.int64, count)
    data = np.frombuffer(b"".join(w.ljust(n, b"\0") for w in words), np.uint8).reshape(count, n)
    inside = np.arange(n)[None, :] < sizes[:, None]
    ids = np.where(inside, merges.byte_ids[data], -1)
    size = 1 << max(0, (n - 1)).bit_length()
    tree = np.full((count, 2 * size), _NONE)
    if n > 1:
        rank = merges.rank(ids[:, :-1], ids[:, 1:])
        tree[:, size : size + n - 1] = np.where(rank == _NONE, _NONE, rank << 32 | np.arange(n - 1))
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    after = np.tile(np.arange(1, n + 1), (count, 1))
    before = np.tile(np.arange(-1, n - 1), (count, 1))
    live = inside.copy()

    def put(row: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        node = size + i
        tree[row, node] = value
        for _ in range(size.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def key(row: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        some = (i >= 0) & (j < n)
        left = np.where(some, ids[row, np.maximum(i, 0)], -1)
        right = np.where(some, ids[row, np.minimum(j, n - 1)], -1)
        rank = merges.rank(left, right)
        return np.where(rank == _NONE, _NONE, rank << 32 | i)

    row = np.flatnonzero(tree[:, 1] != _NONE) if n > 1 else np.zeros(0, np.int64)
    while len(row):
        best = tree[row, 1]
        i = best & 0xFFFFFFFF
        ids[row, i] = best >> 32
        gone = after[row, i]
        follows = after[row, gone]
        after[row, i] = follows
        live[row, gone] = False
        has = follows < n
        before[row[has], follows[has]] = i[has]
        put(row, gone, np.full(len(row), _NONE))
        put(row, i, key(row, i, follows))
        ahead = before[row, i]
        some = ahead >= 0
        put(row[some], ahead[some], key(row[some], ahead[some], i[some]))
        row = row[tree[row, 1] != _NONE]
    flat = ids[live].astype("<u4").tobytes()
    ends = np.concatenate([[0], np.cumsum(live.sum(axis=1))]) * 4
    return [flat[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]


class Encoder:
    """Encodes texts match by match; every different match is merged once while it is kept."""

    def __init__(self, ranks_path: str, pattern: str):
        self.merges = Merges(read_ranks(ranks_path))
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _merged(self, matches: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for match in matches:
            word = match.encode()
            whole = self.merges.ranks.get(word)  # a match that is a token needs no merges
            if whole is not None:
                out[match] = whole.to_bytes(4, "little")
            elif len(word) > SIDE_BY_SIDE:
                out[match] = np.array(merge_one(word, self.merges), "<u4").tobytes()
            else:
                classes.setdefault(max(0, len(word) - 1).bit_length(), []).append((match, word))
        for some in classes.values():
            for a in range(0, len(some), 20_000):
                part = some[a : a + 20_000]
                out.update(zip((m for m, _ in part), merge_many([w for _, w in part], self.merges)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.find(t) for t in texts]
        every = set().union(*split)
        fresh = [m for m in every if m not in self.known]
        if len(self.known) + len(fresh) > KEPT_MATCHES:
            self.known, fresh = {}, list(every)
        new = self._merged(fresh)
        self.known.update((m, ids) for m, ids in new.items() if len(m) <= SIDE_BY_SIDE)
        long = {m: ids for m, ids in new.items() if len(m) > SIDE_BY_SIDE}
        get = self.known.__getitem__ if not long else lambda m: self.known.get(m) or long[m]
        return [b"".join(map(get, matches)) for matches in split]


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_TOKENS: dict[str, pa.Array] = {}


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, binary, little-endian unsigned 32-bit.

    Text is cut by ``pattern``, and each match encoded by the ranks alone; there
    are no special tokens. Null and empty texts have no ids; null doc_ids and
    repeated rows are kept. Nothing is shuffled. Matches with a long run of one
    kind of character cost n log n.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (ranks_path, pattern) not in _ENCODERS:
            _ENCODERS[ranks_path, pattern] = Encoder(ranks_path, pattern)
        encoder = _ENCODERS[ranks_path, pattern]
        for batch in text_slices(batches, most=2 << 20):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary")


def decoded(ids: Column, ranks_path: str) -> Column:
    """The bytes that ids (binary, little-endian unsigned 32-bit) stand for; null for null."""

    def decode(batch: pa.RecordBatch) -> pa.Array:
        data, ends = joined_bytes(batch.column("ids"))
        bytes_, at = joined_bytes(_TOKENS[ranks_path].take(pa.array(data.view("<u4"))))
        buffers = [None, pa.py_buffer(at[ends // 4].astype(np.int32)), pa.py_buffer(bytes_)]
        return pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)

    @F.arrow_udf("binary")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if ranks_path not in _TOKENS:
            tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
            _TOKENS[ranks_path] = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())
        for array in arrays:
            batch = pa.RecordBatch.from_arrays([array.fill_null(b"")], names=["ids"])
            parts = [decode(part) for part in text_slices([batch], text="ids", most=2 << 20)]
            whole = pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
            yield pc.if_else(array.is_valid(), whole, pa.scalar(None, pa.binary())) if array.null_count else whole

    return run(ids)
