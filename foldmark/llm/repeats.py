"""Repeated byte strings: bucket-pointer refinement over a sparse set of suffixes.

A suffix array over all bytes of a corpus cannot be shuffled, so only suffixes
at anchors are bucketed: in every window of ``length`` bytes the q-gram with the
least hash is its anchor. Equal windows have equal anchors at equal places, so
nothing that repeats is missed.

1. Initial buckets: anchors by their q-gram. Each is refined by the whole stretch
   that the windows of this anchor cover. Of equal stretches all but the first
   repeat it entirely. A bucket that holds one stretch only is done.
2. Buckets with different stretches may share some windows. The stretches' bytes
   are fetched, and their windows refined as suffixes: buckets of 8 bytes, then
   pairs of bucket pointers 8, 16, 32 bytes apart, and so on up to the window.
   Of very frequent q-grams the windows are dealt out by their hashes instead.
3. What was found is removed where the documents are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written
from .batches import joined_bytes, keyed_texts, text_slices

#: Bytes of the q-gram that names an initial bucket, and of text behind one partition of each shuffle.
GRAM, BUCKET_BYTES = 32, 16 << 20
#: A q-gram with more stretches than this in one slice is dealt out by stretch; in one bucket, by window.
FREQUENT_HERE, FREQUENT = 4, 256
SLICE = 2 << 20
#: Bytes of stretches that are refined together; a q-gram that isn't frequent has far fewer.
COMPARED_BYTES = 1 << 20

_NO_ID = np.iinfo(np.int64).min
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SUBSTITUTE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE + 4096)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SUBSTITUTE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * _powers(len(prefix))[1][start]


def anchors(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each run of windows with one anchor: (q-gram hash, stretch hash, first window, windows after it, anchor's offset).

    ``valid`` marks the starts of windows that lie within one document.
    """
    windows = np.flatnonzero(valid)
    if not len(windows):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    gram, width, n = _SUBSTITUTE[data], 1, len(data)
    factor = int(_BASE)
    while width < GRAM:
        gram = gram[:-width] * np.uint64(factor) + gram[width:]
        factor, width = factor * factor % (1 << 64), width * 2
    gram = mixed(gram)
    # 40 bits of the hash, and the place: the least is the leftmost of equal q-grams.
    least = (gram & ~np.uint64(0xFFFFFF)) | np.arange(len(gram), dtype=np.uint64)
    wide, span = length - GRAM + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = wide - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    at = (least[windows] & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    last = np.append(first[1:], len(windows)) - 1
    start, more, place = windows[first], windows[last] - windows[first], at[first]
    prefix = prefix_hashes(data)
    stretch = span_hash(prefix, start, start + more + length)
    stretch = mixed(stretch ^ mixed(((place - start) * 1024 + more).astype(np.uint64)))
    return gram[place], stretch, start, more, place - start


def _blobs(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, list[bytes]]]:
    """Columns packed into one binary per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(bucket))
    out = {}
    for name, values in columns.items():
        raw, w = values[order].tobytes(), values.dtype.itemsize
        out[name] = [raw[a * w : z * w] for a, z in zip(starts.tolist(), ends.tolist())]
    return bucket[starts], out


def _unpacked(frame: pd.DataFrame, types: dict[str, str]) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(b"".join(frame[c]), t) for c, t in types.items()}


#: A document is known by its id and a hash of its text, which tells apart those that share an id or have none.
_FOUND = {"gram": "<u8", "stretch": "<u8", "doc": "<i8", "version": "<i8", "start": "<i4", "more": "u1", "place": "u1"}
_ASKED = {"gram": "<u8", "doc": "<i8", "version": "<i8", "start": "<i4", "more": "u1"}
_PART = {"doc": "<i8", "version": "<i8", "start": "<i4", "size": "<i4"}
_FOUND_SCHEMA = "bucket int, kind int, " + ", ".join(f"{c} binary" for c in _FOUND)
_REFINED_SCHEMA = "bucket int, kind int, gram binary, doc binary, version binary, start binary, more binary, size binary"
_FETCHED_SCHEMA = "bucket int, kind int, gram binary, doc binary, version binary, start binary, more binary, body binary"
_TEXTS_SCHEMA = "bucket int, doc binary, version binary, size binary, body binary, carried binary"
#: kinds of rows
_STRETCH, _PARTLY, _REMOVED, _MARK, _FREQUENT = 0, 1, 2, 3, 4


def _names(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Id and version of each document."""
    docs = batch.column("doc_id").fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False).astype("<i8")
    return docs, batch.column("version").to_numpy(zero_copy_only=False).astype("<i8")


def _bucket_of(doc: np.ndarray, version: np.ndarray, buckets: int) -> np.ndarray:
    return mixed(doc.view("<u8") ^ mixed(version.view("<u8"))) % np.uint64(buckets)


def _windows_of(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, valid window starts, offset of the document at each document, doc ids, versions) of a slice; long texts in parts."""
    data, ends = joined_bytes(batch.column("text"))
    docs, versions = _names(batch)
    sizes = np.diff(ends)
    if len(data) <= 2 * SLICE:
        valid = np.zeros(max(0, len(data) - length + 1), bool)
        marks = np.zeros(len(valid) + 1, np.int64)
        some = sizes >= length
        np.add.at(marks, ends[:-1][some], 1)
        np.add.at(marks, ends[1:][some] - length + 1, -1)
        valid[:] = np.cumsum(marks)[:-1] > 0
        yield data, valid, ends[:-1], docs, versions
        return
    for a in range(0, len(data) - length + 1, SLICE):  # one long text: parts share length - 1 bytes
        part = data[a : a + SLICE + length - 1]
        yield part, np.ones(len(part) - length + 1, bool), np.array([-a]), docs, versions


def _later(again: np.ndarray, doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of sorted entries that are ``again`` what the one before is: those not at the very place of the first of them."""
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(doc))))
    return again & ((doc != doc[head]) | (version != version[head]) | (start != start[head]))


def _find(length: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices([whole], most=SLICE):
                for part in _windows_of(batch, length):
                    yield from found(*part)

    def found(data, valid, at, docs, versions) -> Iterator[pa.RecordBatch]:
        gram, stretch, start, more, place = anchors(data, valid, length)
        if not len(gram):
            return
        of = np.searchsorted(at, start, side="right") - 1
        doc, version, start = docs[of], versions[of], start - at[of]
        order = np.lexsort((start, version, doc, stretch, gram))
        gram, stretch, doc, version, start, more, place = (x[order] for x in (gram, stretch, doc, version, start, more, place))
        again = np.concatenate([[False], (gram[1:] == gram[:-1]) & (stretch[1:] == stretch[:-1])])
        later = _later(again, doc, version, start)
        columns = dict(zip(_FOUND, (x.astype(t) for x, t in zip((gram, stretch, doc, version, start, more, place), _FOUND.values()))))
        first = {c: x[~again] for c, x in columns.items()}
        _, inverse, counts = np.unique(first["gram"], return_inverse=True, return_counts=True)
        many = counts[inverse] > FREQUENT_HERE
        own = np.where(many, mixed(first["gram"] ^ first["stretch"]), first["gram"]) % np.uint64(buckets)
        marked = np.unique(first["gram"][many])
        marks = {c: np.zeros(len(marked), t) for c, t in _FOUND.items()} | {"gram": marked}
        gone = {c: x[later] for c, x in columns.items()}
        for kind, bucket, some in (
            (_STRETCH, own[~many], {c: x[~many] for c, x in first.items()}), (_FREQUENT, own[many], {c: x[many] for c, x in first.items()}),
            (_MARK, marked % np.uint64(buckets), marks), (_REMOVED, _bucket_of(gone["doc"], gone["version"], buckets), gone),
        ):
            names, blobs = _blobs(bucket, some)
            if len(names):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), pa.array(np.full(len(names), kind, np.int32)), *(pa.array(x, pa.binary()) for x in blobs.values())],
                    names=["bucket", "kind", *blobs],
                )

    return run


def _by_document(kind: int, buckets: int, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    names, blobs = _blobs(_bucket_of(columns["doc"], columns["version"], buckets), columns)
    empty = {c: [b""] * len(names) for c in ("gram", "doc", "version", "start", "more", "size")}
    return pd.DataFrame({"bucket": names.astype(np.int32), "kind": np.int32(kind)} | empty | blobs)


def _refine(length: int, buckets: int):
    """Stretches of one bucket of q-grams: what repeats entirely, and what must be compared."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        local = _unpacked(frame[frame["kind"] == _REMOVED], _FOUND)
        out.append((local["doc"], local["version"], local["start"], local["more"]))
        hot_grams = np.unique(_unpacked(frame[frame["kind"] == _MARK], {"gram": "<u8"})["gram"])
        asked = []
        for kind in (_STRETCH, _FREQUENT):
            x = _unpacked(frame[frame["kind"] == kind], _FOUND)
            gram, stretch, doc, version, start, more = (x[c] for c in ("gram", "stretch", "doc", "version", "start", "more"))
            if not len(gram):
                continue
            order = np.lexsort((start, version, doc, stretch, gram))
            gram, stretch, doc, version, start, more = (v[order] for v in (gram, stretch, doc, version, start, more))
            new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
            again = ~new_gram & np.concatenate([[False], stretch[1:] == stretch[:-1]])
            later = _later(again, doc, version, start)
            out.append((doc[later], version[later], start[later], more[later]))
            group = np.cumsum(new_gram) - 1
            different = np.bincount(group, weights=~again)[group]
            hot = np.full(len(gram), kind == _FREQUENT) | (different > FREQUENT) | np.isin(gram, hot_grams)
            want = ~again & ((different > 1) | hot)
            asked.append((gram[want], doc[want], version[want], start[want], more[want], hot[want]))
        doc, version, start, more = (np.concatenate(v) for v in zip(*out))
        frames = [_by_document(_REMOVED, buckets, {
            "doc": doc, "version": version, "start": start, "size": (more.astype("<i4") + length).astype("<i4")})]
        if asked:
            gram, doc, version, start, more, hot = (np.concatenate(v) for v in zip(*asked))
            for kind, some in ((_PARTLY, ~hot), (_FREQUENT, hot)):
                frames.append(_by_document(kind, buckets, dict(zip(_ASKED, (gram[some], doc[some], version[some], start[some], more[some])))))
        return pd.concat(frames, ignore_index=True)

    return run


def _texts(buckets: int):
    """Documents by bucket, those of a slice compressed together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches, most=2 * SLICE):
            data, ends = joined_bytes(batch.column("text"))
            docs, versions = _names(batch)
            bucket = _bucket_of(docs, versions, buckets)
            rows = []
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                body = b"".join(data[ends[i] : ends[i + 1]].tobytes() for i in own)
                rows.append((int(b), docs[own].tobytes(), versions[own].tobytes(), (ends[own + 1] - ends[own]).astype("<i8").tobytes(), press.compress(body),
                             _packed_rows(batch, own) if batch.num_columns > 3 else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 5))],
                names=["bucket", "doc", "version", "size", "body", "carried"],
            )

    return run


def _packed_rows(batch: pa.RecordBatch, rows: np.ndarray) -> bytes:
    """The carried columns of some rows as a compressed Arrow stream."""
    part = batch.select(list(range(3, batch.num_columns))).take(pa.array(rows))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _documents(frame: pd.DataFrame) -> Iterator[tuple[int, int, np.ndarray]]:
    press = zstandard.ZstdDecompressor()
    for docs, versions, sizes, body in zip(frame["doc"], frame["version"], frame["size"], frame["body"]):
        data = np.frombuffer(press.decompress(body), np.uint8) if len(body) else np.zeros(0, np.uint8)
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))])
        for n, (doc, version) in enumerate(zip(np.frombuffer(docs, "<i8").tolist(), np.frombuffer(versions, "<i8").tolist())):
            yield doc, version, data[ends[n] : ends[n + 1]]


def _rows_of(doc: np.ndarray, version: np.ndarray, d: int, v: int) -> tuple[int, int]:
    """From and to where entries sorted by (doc, version) belong to one document."""
    a, z = np.searchsorted(doc, d, side="left"), np.searchsorted(doc, d, side="right")
    same = version[a:z]
    return a + np.searchsorted(same, v, side="left"), a + np.searchsorted(same, v, side="right")


def _fetch(length: int, buckets: int):
    """The bytes of asked stretches, or for frequent q-grams the hashes of their windows."""

    def run(texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for kind in (_PARTLY, _FREQUENT):
            x = _unpacked(asked[asked["kind"] == kind], _ASKED)
            order = np.lexsort((x["version"], x["doc"]))
            gram, doc, version, start, more = (x[c][order] for c in _ASKED)
            bodies, who, hashes = [], [], []
            if len(doc):
                seen = set()
                for d, v, data in _documents(texts):
                    own = np.arange(*_rows_of(doc, version, d, v))
                    if not len(own) or (d, v) in seen:  # rows that are alike are asked once
                        continue
                    seen.add((d, v))
                    who.append(own)
                    if kind == _PARTLY:
                        raw = data.tobytes()
                        bodies += [raw[s : s + m + length] for s, m in zip(start[own].tolist(), more[own].tolist())]
                    else:
                        prefix = prefix_hashes(data)
                        n = more[own].astype(np.int64) + 1
                        at = np.repeat(start[own].astype(np.int64) - np.cumsum(n) + n, n) + np.arange(n.sum())
                        hashes.append((np.repeat(own, n), at, mixed(span_hash(prefix, at, at + length))))
            if not who:
                continue
            if kind == _PARTLY:
                own = np.concatenate(who)
                bucket = (gram[own] % np.uint64(buckets)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                starts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[by]) != 0]))
                for a, z in zip(starts.tolist(), np.append(starts[1:], len(by)).tolist()):
                    part = by[a:z]
                    rows = own[part]
                    frames.append(pd.DataFrame({
                        "bucket": [bucket[part[0]]], "kind": np.int32(_PARTLY), "gram": [gram[rows].tobytes()], "doc": [doc[rows].tobytes()],
                        "version": [version[rows].tobytes()], "start": [start[rows].tobytes()], "more": [more[rows].tobytes()], "body": [b"".join(bodies[i] for i in part.tolist())],
                    }))
            else:
                own, at, hashed = (np.concatenate(v) for v in zip(*hashes))
                order = np.lexsort((at, version[own], doc[own], hashed, gram[own]))
                own, at, hashed = own[order], at[order], hashed[order]
                names, blobs = _blobs(hashed % np.uint64(buckets), {
                    "gram": gram[own], "doc": doc[own], "version": version[own], "start": at.astype("<i4"), "body": hashed})
                frames.append(pd.DataFrame({"bucket": names.astype(np.int32), "kind": np.int32(_FREQUENT), "more": [b""] * len(names)} | blobs))
        columns = ["bucket", "kind", "gram", "doc", "version", "start", "more", "body"]
        return pd.concat(frames, ignore_index=True)[columns] if frames else pd.DataFrame({c: [] for c in columns})

    return run


def bucket_pointers(data: np.ndarray, length: int) -> np.ndarray:
    """For every position a bucket number; positions share it only if their next ``length`` bytes are equal.

    Starts from 8-byte buckets. A step sorts the members of buckets that still
    have several by (own pointer, pointer ``step`` bytes on), which doubles the
    length that is known to be equal, and gives them new pointers; those alone
    in a bucket keep theirs, which later steps use as they are. Positions too
    near the end are alone.
    """
    n = len(data)
    alone = np.arange(n, dtype=np.int64)
    if n < length or length < 8:
        return alone
    value = data.astype(np.uint64)
    for width in (1, 2, 4):
        value = (value[:-width] << np.uint64(8 * width)) | value[width:]
    pointer = alone.copy()
    _, pointer[: len(value)] = np.unique(value, return_inverse=True)
    pointer[len(value) :] = n + alone[len(value) :]
    known = 8
    while known < length:
        step = min(known, length - known)
        last = n - known - step + 1
        counts = np.bincount(pointer)
        several = counts[pointer] > 1
        several[max(last, 0) :] = False
        at = np.flatnonzero(several)
        cut = np.flatnonzero(counts[pointer] > 1)
        cut = cut[cut >= max(last, 0)]
        top = int(pointer.max()) + 1
        old = pointer.copy()
        _, fresh = np.unique(old[at] * np.int64(top) + old[at + step], return_inverse=True)
        pointer[at] = top + fresh
        pointer[cut] = top + len(at) + np.arange(len(cut))
        known += step
    return pointer


def _compare(length: int, buckets: int):
    """Windows of the fetched stretches that an earlier place has too."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        partly = frame[frame["kind"] == _PARTLY]
        if len(partly):
            x = _unpacked(partly, {"gram": "<u8", "doc": "<i8", "version": "<i8", "start": "<i4", "more": "u1", "body": "u1"})
            size = x["more"].astype(np.int64) + length
            base = np.cumsum(size) - size
            order = np.argsort(x["gram"], kind="stable")
            ends = np.cumsum(size[order])
            new_gram = np.flatnonzero(np.diff(x["gram"][order])) + 1
            a = 0
            while a < len(order):  # whole q-grams, some COMPARED_BYTES at a time
                z = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED_BYTES))
                more = new_gram[new_gram > z]
                z = int(more[0]) if len(more) else len(order)
                own, a = order[a:z], z
                n, starts = size[own], np.cumsum(size[own]) - size[own]
                body = x["body"][np.repeat(base[own] - starts, n) + np.arange(n.sum())]
                pointer = bucket_pointers(body, length)
                n = n - length + 1
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                same = pointer[np.repeat(starts, n) + inner].astype(np.uint64)
                several = np.bincount(pointer)[same.view(np.int64)] > 1
                doc, version = (np.repeat(x[c][own], n)[several] for c in ("doc", "version"))
                start = (np.repeat(x["start"][own].astype(np.int64), n) + inner)[several]
                out.append((np.zeros(len(doc), np.uint64), same[several], doc, version, start))
        hashed = frame[frame["kind"] == _FREQUENT]
        if len(hashed):
            x = _unpacked(hashed, {"gram": "<u8", "body": "<u8", "doc": "<i8", "version": "<i8", "start": "<i4"})
            out.append((x["gram"], x["body"], x["doc"], x["version"], x["start"].astype(np.int64)))
        frames = []
        for gram, same, doc, version, start in out:
            order = np.lexsort((start, version, doc, same, gram))
            gram, same, doc, version, start = (v[order] for v in (gram, same, doc, version, start))
            again = np.concatenate([[False], (gram[1:] == gram[:-1]) & (same[1:] == same[:-1])])
            later = _later(again, doc, version, start)
            doc, version, start = doc[later], version[later], start[later]
            order = np.lexsort((start, version, doc))
            doc, version, start = doc[order], version[order], start[order]
            if len(doc):
                other = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])
                first = np.flatnonzero(np.concatenate([[True], other | (start[1:] > start[:-1] + 1)]))
                last = np.append(first[1:], len(doc)) - 1
                frames.append(_by_document(_REMOVED, buckets, {
                    "doc": doc[first], "version": version[first], "start": start[first].astype("<i4"), "size": (start[last] - start[first] + length).astype("<i4")}))
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(
            {c: [] for c in ("bucket", "kind", "gram", "doc", "version", "start", "more", "size")})

    return run


def _remove(length: int, as_text: bool):
    def run(texts: pa.Table, removed: pa.Table) -> pa.Table:
        x = _unpacked(removed.select(list(_PART)).to_pandas(), _PART)
        order = np.lexsort((x["version"], x["doc"]))
        doc, version, start, size = (x[c][order].astype(np.int64) for c in _PART)
        ids, sizes, spans, kept, seen = [], [], [], [], set()
        for d, v, data in _documents(texts.select(["doc", "version", "size", "body"]).to_pandas()):
            a, z = _rows_of(doc, version, d, v)
            cover = np.zeros(len(data) + 1, np.int64)
            if z > a:
                np.add.at(cover, np.minimum(start[a:z], len(data)), 1)
                np.add.at(cover, np.minimum(start[a:z] + size[a:z], len(data)), -1)
            gone = np.cumsum(cover)[:-1] > 0
            if d == _NO_ID:  # equal texts without an id are documents of their own: all but one repeat it entirely
                gone |= v in seen and len(data) >= length
                seen.add(v)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            ids.append(None if d == _NO_ID else d)
            sizes.append(len(data))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
            left = data[~gone].tobytes()
            kept.append(left.decode("utf-8", "ignore") if as_text else left)
        out = pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
        })
        carried = [pa.ipc.open_stream(raw).read_all() for raw in texts.column("carried").to_pylist() if raw is not None]
        if carried:
            for name, column in zip(carried[0].column_names, pa.concat_tables(carried).columns):
                out = out.append_column(name, column)
        return out

    return run


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   carry: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    """Every document without the bytes that an earlier equal string of ``length`` bytes covers.

    Returns doc_id, n_bytes, spans (array of removed runs: start, end) and kept
    (binary), and then the columns to ``carry``, as carried_0, carried_1, ... With
    ``as_text``, kept is a string, and a character of which some bytes go goes whole. Earlier is a smaller doc_id, or a smaller start in the same
    document; matches never cross documents and are judged on the input. Null
    and empty texts have no bytes; shorter texts are kept. A null id comes
    before all others. Different texts that share an id, or have none, are
    documents of their own, in the order of a hash of the text. Of equal texts
    without an id one stays; rows with equal id and text are one document, and
    don't repeat each other. An empty table stays empty.

    Texts are shuffled twice, compressed; anchors once. Buckets grow in number
    with the bytes of text, so each holds a bounded share; a q-gram that is in
    very many documents is dealt out by its stretches and windows.
    """
    if not GRAM <= length <= GRAM + 255:
        raise ValueError(f"the length must be from {GRAM} to {GRAM + 255}")
    keyed = keyed_texts(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total // BUCKET_BYTES))
    found = keyed.mapInArrow(_find(length, buckets), _FOUND_SCHEMA)
    refined = written(found.groupBy("bucket").applyInPandas(_refine(length, buckets), _REFINED_SCHEMA), "refined")
    id_and_text = [docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")]
    with_carried = docs.select(*id_and_text, F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("version"), *[docs[c].alias(f"carried_{i}") for i, c in enumerate(carry)])
    texts = keyed.mapInArrow(_texts(buckets), _TEXTS_SCHEMA)
    full_texts = with_carried.mapInArrow(_texts(buckets), _TEXTS_SCHEMA) if carry else texts
    kind = "string" if as_text else "binary"
    schema = StructType.fromDDL(f"doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept {kind}")
    schema = StructType([*schema.fields, *with_carried.schema.fields[3:]])
    asked = refined.where(F.col("kind") != _REMOVED)
    fetched = texts.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(_fetch(length, buckets), _FETCHED_SCHEMA)
    compared = fetched.groupBy("bucket").applyInPandas(_compare(length, buckets), _REFINED_SCHEMA)
    removed = refined.where(F.col("kind") == _REMOVED).unionByName(compared).select("bucket", "doc", "version", "start", "size")
    return full_texts.groupBy("bucket").cogroup(removed.groupBy("bucket")).applyInArrow(_remove(length, as_text), schema)
