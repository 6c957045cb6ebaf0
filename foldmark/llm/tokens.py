"""Token ids of whole texts by an existing tokenizer file, cut into pieces of bounded length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .batches import joined_bytes, keyed_texts, raw_texts, text_slices

#: Ids of so many different cores are kept by a worker before it starts anew; longer ones aren't kept.
KEPT_CORES, KEPT_BYTES = 400_000, 64
#: Bytes of text encoded together: the more, the fewer runs are met again.
TOGETHER_BYTES = 8 << 20
#: Punctuation that is cut from the end of a run where a letter or digit is in front of it: always tokens of its own.
_TAIL = b".,;:!?|*$%&#-_()[]{}\"/\\<>=+~^@`"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, nth bigint"


class RunEncoder:
    """Encodes runs of text between white space, each core of a run once.

    For tokenizers that lower-case, whose tokens never hold or depend on white
    space, and that never join letters or digits with punctuation behind them
    (apostrophes apart): then a text's ids are those of its cores and tails.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _batch(self, cores: list[bytes]) -> dict[bytes, bytes]:
        got = self.tokenizer.encode_batch_fast([c.decode() for c in cores], add_special_tokens=False)
        return {c: np.array(e.ids, "<u4").tobytes() for c, e in zip(cores, got)}

    def _words(self, cores: list[bytes]) -> dict[bytes, bytes]:
        """For cores of letters only: encoded as one text, cut where words end."""
        whole = self.tokenizer.encode_batch_fast([b" ".join(cores).decode()], add_special_tokens=False)[0]
        ids = np.array(whole.ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(cores):
            return self._batch(cores)
        raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return {c: raw[a:z] for c, a, z in zip(cores, at[:-1], at[1:])}

    @staticmethod
    def _cut(run: bytes) -> tuple[bytes, bytes]:
        """Core and tail of a run that isn't plain ASCII letters and punctuation."""
        core = run.rstrip(_TAIL)
        if b"<|" in run or not core or not (core[-1:].isalnum() or core[-1] >= 128 and core.decode()[-1].lower().isalpha()):
            core = run  # a special token, or a core that may join its tail
        tail = run[len(core) :]
        # Accents that stand alone may join a small letter but not its capital.
        return (core if b"<|" in core or b"\xcc" in core or b"\xcd" in core else core.lower()), tail

    def _runs(self, runs: list[bytes]) -> list[bytes]:
        cores = [run.rstrip(_TAIL) for run in runs]
        tails = [run[len(core) :] for run, core in zip(runs, cores)]
        cores = [core.lower() for core in cores]
        for i, core in enumerate(cores):
            if not core.isalpha():  # of bytes: ASCII letters only
                cores[i], tails[i] = self._cut(runs[i])
        wanted = set(cores)
        wanted.update(tails)
        if len(self.known) + len(wanted) > KEPT_CORES:
            self.known = {}
        fresh = sorted(wanted.difference(self.known))
        letters = [core.isalpha() or len(core) <= KEPT_BYTES and core.decode().isalpha() for core in fresh]
        ids, long = self.known, [core for core in fresh if len(core) > KEPT_BYTES]
        for encode, some in ((self._words, [c for c, x in zip(fresh, letters) if x]), (self._batch, [c for c, x in zip(fresh, letters) if not x])):
            for a in range(0, len(some), 2_000):
                ids.update(encode(some[a : a + 2_000]))
        out = [ids[core] + ids[tail] if tail else ids[core] for core, tail in zip(cores, tails)]
        for core in long:
            del ids[core]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids = pa.array(self._runs(raw_texts(coded.dictionary)), pa.large_binary()).take(coded.indices)
        data, ends = joined_bytes(ids)
        at = ends[np.asarray(split.offsets) - split.offsets[0].as_py()].tolist()
        raw = data.tobytes()
        return [raw[a:z] for a, z in zip(at[:-1], at[1:])]


_ENCODERS: dict[str, RunEncoder] = {}


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids, with ``end_id`` after them, in pieces of at most ``capacity`` ids.

    ``ids`` is binary, little-endian unsigned 32-bit. ``part`` and ``nth``
    number the pieces of a length within the task that made them; write the
    table before they are used, so that all readers see one numbering. Null
    and empty texts are one piece that holds just ``end_id``; null ids stay
    null; repeated rows give their pieces each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = RunEncoder(tokenizer_path)
        encoder = _ENCODERS[tokenizer_path]
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        last = np.array([end_id], "<u4").tobytes()
        for batch in text_slices(batches, most=TOGETHER_BYTES):
            ids, rows = [], []
            for doc, whole in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                whole += last
                n = len(whole) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    size = min(capacity, n - start)
                    rows.append((doc, piece, start, size, int(seen[size])))
                    ids.append(whole[4 * start : 4 * (start + size)])
                    seen[size] += 1
            if not rows:
                continue
            doc, piece, start, size, nth = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "part", "nth"],
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, PIECES)
