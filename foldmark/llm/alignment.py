"""Two tokenizers' tokens of the same text: groups between common ends, and which ids are linked how often."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .batches import joined_bytes, keyed_texts, text_slices

#: Bytes of text that one step works on, and links that one row of pairs may stand for.
STEP_BYTES, ROW_LINKS = 1 << 20, 2_000_000
#: A run of white space from which on the quick encoder's pattern may run out of stack.
_LONG_BLANK = re.compile(r"\s{1000}")

_ALIGNED = ("row bigint, part int, block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
            "pairs binary, times binary, block_pairs binary, block_documents binary")
_SUMS = "row bigint, n_best bigint, count_sum bigint"
_SIZES = ("n_a", "n_b", "n_groups", "n_links")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers: ids of texts, and each id's bytes."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(a_path)
        self.slow.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as file:
            special = {t["id"] for t in json.load(file)["added_tokens"]}
        letters, vocabulary = _byte_letters(), self.slow.get_vocab()
        known = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if i not in special}
        self.a_bytes = pa.array([known.get(i, b"") for i in range(max(vocabulary.values()) + 1)], pa.large_binary())
        # Its merges are in the order of their ids, so the ranks are the ids.
        self.quick = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={t: i for i, t in known.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = pa.array([self._piece(i) for i in range(self.b.get_piece_size())], pa.large_binary())
        a, b = len(self.a_bytes), len(self.b_bytes)
        ends = [f"{i}{end}" for i in range(a) for end in ",|"] + [f"{i}{end}" for i in range(b) for end in ",;"]
        self.written_ids = pa.array(ends, pa.large_binary())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if len(text) >= 1000 and _LONG_BLANK.search(text):
            return self.slow.encode(" " + text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(" " + text)

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1) if texts else []


def gallop(driver: np.ndarray, longer: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The first place in ``longer`` from ``start`` on, before ``stop``, that holds at least each driver's value.

    ``longer`` rises between start and stop, and its last value there is no
    smaller than the driver's. Each step doubles until it has passed the value,
    then the last step is halved; all drivers take a step together.
    """
    low, step = start.copy(), 1  # all places before ``low`` hold less
    high = np.full(len(driver), -1, np.int64)
    open_ = np.arange(len(driver))
    while len(open_):
        ahead = np.minimum(low[open_] + step - 1, stop[open_] - 1)
        passed = longer[ahead] >= driver[open_]
        high[open_[passed]] = ahead[passed]
        open_ = open_[~passed]
        low[open_] = ahead[~passed] + 1
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        up = longer[middle] < driver[open_]
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


#: Drivers that find their way from a common start, one group after the other as the first driver of each is found.
_STRIDE = 32


def common_ends(a: np.ndarray, b: np.ndarray, a_start: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends that they share, document by document (starts, with the total at the end).

    The shorter list of a document drives. Every so many of its ends gallop
    from the document's start, and those between from where the last of them
    was found.
    """
    found = []
    shorter = np.diff(a_start) <= np.diff(b_start)
    for drives, own, other, own_start, other_start in ((shorter, a, b, a_start, b_start), (~shorter, b, a, b_start, a_start)):
        size = np.where(drives, np.diff(own_start), 0)
        document = np.repeat(np.arange(len(size)), size)
        rank = np.arange(len(document)) - np.repeat(np.cumsum(size) - size, size)
        place = own_start[document] + rank
        first, last = other_start[document], other_start[document + 1]
        leads = rank % _STRIDE == 0
        at = np.zeros(len(place), np.int64)
        at[leads] = gallop(own[place[leads]], other, first[leads], last[leads])
        behind = at[leads][np.cumsum(leads) - 1] if len(place) else at
        at[~leads] = gallop(own[place[~leads]], other, behind[~leads], last[~leads])
        same = other[at] == own[place] if len(place) else np.zeros(0, bool)
        found.append((place[same], at[same]))
    (a1, b1), (b2, a2) = found
    at_a, at_b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given sizes: the run of every element, and its place in it."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _summed(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their weights (None: their number)."""
    if weights is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


class Slice:
    """The aligned tokens of some documents."""

    def __init__(self, pair: Pair, texts: pa.Array):
        plain = texts.to_pylist()
        filled = [i for i, t in enumerate(plain) if t]
        a_ids, b_ids = [[]] * len(plain), [[]] * len(plain)
        for i, ids in zip(filled, pair.encode_b([plain[i] for i in filled])):
            a_ids[i], b_ids[i] = pair.encode_a(plain[i]), ids
        (self.a, a_at, a_ends), (self.b, b_at, b_ends) = (self._flat(x, t) for x, t in ((a_ids, pair.a_bytes), (b_ids, pair.b_bytes)))
        a_data, b_data = self._bytes(self.a, pair.a_bytes), self._bytes(self.b, pair.b_bytes)
        keep = np.zeros(len(plain), bool)
        for i in filled:
            whole = b" " + plain[i].encode()
            keep[i] = a_data[a_ends[a_at[i]] : a_ends[a_at[i + 1]]] == whole == b_data[b_ends[b_at[i]] : b_ends[b_at[i + 1]]]
        self.n_a, self.n_b = np.where(keep, np.diff(a_at), 0), np.where(keep, np.diff(b_at), 0)
        a_kept, b_kept = np.repeat(keep, np.diff(a_at)), np.repeat(keep, np.diff(b_at))
        self.a, a_size = self.a[a_kept], np.diff(a_ends)[a_kept]
        self.b, b_size = self.b[b_kept], np.diff(b_ends)[b_kept]
        self.a_at, self.b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        last_a, last_b = common_ends(np.cumsum(a_size), np.cumsum(b_size), self.a_at, self.b_at)
        # Differences of ranks are the groups' sizes.
        self.group_a, self.group_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        self.last_a, self.last_b = last_a, last_b
        self.document = np.repeat(np.arange(len(plain)), self.n_a)[last_a]
        self.n_groups = np.bincount(self.document, minlength=len(plain))
        self.links = self.group_a * self.group_b
        self.n_links = np.zeros(len(plain), np.int64)
        np.add.at(self.n_links, self.document, self.links)
        self.pair = pair

    @staticmethod
    def _flat(ids: list[list[int]], table: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        flat = np.fromiter(chain.from_iterable(ids), np.int64, at[-1])
        sizes = np.diff(joined_bytes(table)[1])
        return flat, at, np.concatenate([[0], np.cumsum(sizes[flat])])

    @staticmethod
    def _bytes(ids: np.ndarray, table: pa.Array) -> bytes:
        return joined_bytes(table.take(pa.array(ids)))[0].tobytes()

    def groups(self) -> list[str]:
        """Each document's groups as text: ids of the first tokenizer, a bar, ids of the second; groups by semicolons."""
        group_of_a, _ = _spread(self.group_a)
        group_of_b, _ = _spread(self.group_b)
        out = np.zeros(len(self.a) + len(self.b), np.int64)
        a_place = np.arange(len(self.a)) + (self.last_b - self.group_b + 1)[group_of_a]
        b_place = np.arange(len(self.b)) + (self.last_a + 1)[group_of_b]
        a_closes, b_closes = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        a_closes[self.last_a] = 1
        b_closes[self.last_b] = 1
        out[a_place] = 2 * self.a + a_closes
        out[b_place] = 2 * (len(self.pair.a_bytes) + self.b) + b_closes
        data, ends = joined_bytes(self.pair.written_ids.take(pa.array(out)))
        data, at = data.tobytes(), ends[self.a_at + self.b_at].tolist()
        return [data[x : max(x, z - 1)].decode() for x, z in zip(at[:-1], at[1:])]

    def _pairs(self, groups: slice, scale: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, id, id) keys of these groups with their number of links; one link at a time."""
        first_a, first_b = (last - size + 1 for last, size in ((self.last_a, self.group_a), (self.last_b, self.group_b)))
        run, inner = _spread(self.links[groups])
        wide = self.group_b[groups][run]
        a = self.a[first_a[groups][run] + inner // wide]
        b = self.b[first_b[groups][run] + inner % wide]
        return _summed((self.document[groups][run] << 32) + a * scale + b, None)

    def _long_pairs(self, groups: slice, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for a document with very many links: equal ids of a group count together, and some first ids go at a time."""
        count = groups.stop - groups.start
        sides = []
        for ids, last, sizes in ((self.a, self.last_a, self.group_a), (self.b, self.last_b, self.group_b)):
            begin = last[groups][0] - sizes[groups][0] + 1
            run, _ = _spread(sizes[groups])
            sides.append(_summed((run << 32) + ids[begin : begin + len(run)], None))
        (a_keys, a_times), (b_keys, b_times) = sides
        b_start = np.searchsorted(b_keys, np.arange(count + 1) << 32)
        a_group, a = a_keys >> 32, a_keys & 0xFFFFFFFF
        wide = np.diff(b_start)[a_group]
        # First ids in an order, cut where their pairs come to a row's worth; no id is in two parts.
        order = np.argsort(a, kind="stable")
        a, a_group, a_times, wide = a[order], a_group[order], a_times[order], wide[order]
        part = np.cumsum(wide) // ROW_LINKS
        heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        part = part[heads][np.cumsum(np.concatenate([[True], a[1:] != a[:-1]])) - 1]
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            run, inner = _spread(wide[own])
            at = own[run]
            b = b_start[a_group[at]] + inner
            yield _summed(a[at] * scale + (b_keys[b] & 0xFFFFFFFF), a_times[at] * b_times[b])

    def rows(self) -> Iterator[tuple[range, list[tuple[int, int, np.ndarray, np.ndarray]]]]:
        """Runs of documents of bounded links, each with (document, part, pairs, times); a longer one has several runs."""
        scale = len(self.pair.b_bytes)
        group_at = np.concatenate([[0], np.cumsum(self.n_groups)])
        start, n = 0, len(self.n_a)
        total = np.concatenate([[0], np.cumsum(self.n_links)])
        while start < n:
            stop = max(start + 1, int(np.searchsorted(total, total[start] + ROW_LINKS, side="right")) - 1)
            groups = slice(group_at[start], group_at[stop])
            if stop == start + 1 and self.n_links[start] > ROW_LINKS:
                for part, (keys, times) in enumerate(self._long_pairs(groups, scale)):
                    yield range(start, stop), [(start, part, keys, times)]
            else:
                keys, times = self._pairs(groups, scale)
                cut = np.searchsorted(keys, np.arange(start, stop + 1) << 32)
                keys &= 0xFFFFFFFF
                yield range(start, stop), [(d, 0, keys[x:z], times[x:z]) for d, x, z in zip(range(start, stop), cut[:-1], cut[1:])]
            start = stop


_PAIRS: dict[tuple[str, str, str], Pair] = {}


def aligned(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's groups, and its linked id pairs in rows of bounded size.

    Part 0 of a document (``row``) has its sizes and ``groups``; ``pairs`` are
    the distinct linked pairs (first id times the second vocabulary's size plus
    second id, 32 bits each), ``times`` how often each is linked. Rows of a
    ``block`` are together; the first has the block's distinct pairs and in how
    many of its documents each is. Write the table before it is read twice.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (a_path, b_path, pattern)
        if key not in _PAIRS:
            _PAIRS[key] = Pair(*key)
        base = TaskContext.get().partitionId() << 36
        seen = blocks = 0
        for batch in text_slices(batches, most=STEP_BYTES):
            ids = batch.column("doc_id").to_pylist()
            own = Slice(_PAIRS[key], batch.column("text"))
            groups = own.groups()
            for _, parts in own.rows():
                together = np.concatenate([keys for _, _, keys, _ in parts])
                distinct, documents = np.unique(together, return_counts=True)
                out = []
                for i, (d, part, keys, times) in enumerate(parts):
                    sizes = [int(x[d]) if part == 0 else None for x in (own.n_a, own.n_b, own.n_groups, own.n_links)]
                    packed = [x.astype("<u4").tobytes() for x in (keys, times)]
                    block = [x.astype("<u4").tobytes() for x in (distinct, documents)] if i == 0 else [None, None]
                    out.append((base + seen + d, part, base + blocks, ids[d], *sizes, groups[d] if part == 0 else None, *packed, *block))
                blocks += 1
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.string(), *[pa.binary()] * 4)
                names = [field.split()[0] for field in _ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
            seen += batch.num_rows

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, _ALIGNED)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all values of a binary column, and where each value's begin, with the end."""
    data, ends = joined_bytes(column)
    return np.frombuffer(data.tobytes(), "<u4").astype(np.int64), ends // 4


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, pair, documents) of every block's distinct pairs."""
    for batch in batches:
        for i in range(batch.num_rows):  # a block each
            one = batch.slice(i, 1)
            pairs, documents = (_numbers(one.column(c).cast(pa.large_binary()))[0] for c in ("block_pairs", "block_documents"))
            block = np.full(len(pairs), one.column("block")[0].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(pairs), pa.array(documents)], names=["block", "pair", "documents"])


def link_counts(table: DataFrame, second_size: int) -> DataFrame:
    """Each linked pair of ids with the number of documents that hold it: a_id, b_id, pair, documents, best (of its a_id)."""
    counts = asked_pairs(table).groupBy("pair").agg(F.sum("documents").alias("documents"))
    first = F.floor(F.col("pair") / second_size)
    counts = written(counts.select(first.alias("a_id"), F.pmod("pair", F.lit(second_size)).alias("b_id"), "pair", "documents"), "link-counts")
    # One row per id of the first vocabulary: its size bounds the broadcast.
    most = counts.groupBy("a_id").agg(F.max("documents").alias("most"))
    return counts.join(F.broadcast(most), "a_id").select("a_id", "b_id", "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def asked_pairs(table: DataFrame) -> DataFrame:
    few = table.where("block_pairs is not null").select("block", "block_pairs", "block_documents")
    return few.mapInArrow(_asked, "block bigint, pair bigint, documents bigint")


def _sums(table: pa.Table, answers: pa.Table) -> pa.Table:
    """Per row of a block: over its links, how many are their first id's best, and the sum of the counts."""
    pair, documents, best = (answers[c].to_numpy() for c in ("pair", "documents", "best"))
    order = np.argsort(pair)
    pair, documents, best = pair[order], documents[order], best[order]
    sums = []
    for chunk in table.to_batches():
        keys, at = _numbers(chunk.column("pairs").cast(pa.large_binary()))
        times, _ = _numbers(chunk.column("times").cast(pa.large_binary()))
        place = np.searchsorted(pair, keys)
        good = np.concatenate([[0], np.cumsum(times * best[place])]) if len(keys) else np.zeros(1, np.int64)
        total = np.concatenate([[0], np.cumsum(times * documents[place])]) if len(keys) else np.zeros(1, np.int64)
        sums.append((np.diff(good[at]), np.diff(total[at])))
    good, total = (np.concatenate([s[i] for s in sums]).astype(np.int64) if sums else [] for i in (0, 1))
    return pa.table([table["row"], pa.array(good, pa.int64()), pa.array(total, pa.int64())], names=["row", "n_best", "count_sum"])


def document_links(table: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of every document of the written ``aligned`` table."""
    answers = asked_pairs(table).select("block", "pair").join(counts.select("pair", "documents", "best"), "pair").toDF("pair", "block", "documents", "best")
    rows = table.select("block", "row", "pairs", "times")
    sums = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sums, _SUMS)
    return sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def vocabulary_size(b_path: str) -> int:
    """Of the second tokenizer, by which pairs are numbered."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def align_documents(table: DataFrame, second_size: int, *carried: str) -> DataFrame:
    """doc_id, sizes, the ``carried`` columns, n_best and count_sum of every document of the written ``aligned`` table.

    Null and empty texts, and those whose tokens' bytes differ from a space and
    the text, have no tokens: zeros. Every row comes back, whatever its id;
    repeated rows count as documents each. A third of all documents may share
    their pairs: a pair is counted once per block before it crosses the
    shuffle, and is answered once per block. A very long text's pairs come in
    rows of bounded size; memory grows with the longest text's tokens only.
    """
    sums = document_links(table, link_counts(table, second_size))
    heads = table.where("part = 0").select("row", "doc_id", *_SIZES, *carried)
    return heads.join(sums, "row").drop("row")
