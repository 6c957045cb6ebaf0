"""Mutation calling: alignments to counts per design, position and mutation type."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import COVERAGE, MISMATCHES
from .skew import lookup_join

_STEP = "_step"  # change of coverage at a position
_MEASURES = np.array([_STEP, "ins", "del", *MISMATCHES])
_BLOCK = re.compile(r"(\d+)([MIDNSHP=X])")

#: Letters of a library up to which it goes to every task; a larger one is joined.
BROADCAST_LETTERS = 32 << 20
#: Letters of reads walked at once, and rows at most.
SLICE_LETTERS, SLICE_ROWS = 2 << 20, 32_768


def reference_span(cigar: Column) -> Column:
    """Reference positions an alignment extends over."""
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0), lambda acc, x: acc + x.cast("int"))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Letters:
    """The bytes of a string column; what lies outside a row's text is 0."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.start, self.size = bounds[:-1], np.diff(bounds)
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)

    def at(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < self.size[row])
        return np.where(inside, self.data[np.where(inside, self.start[row] + place, 0)], 0)


def cigar_blocks(cigars: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, op, len, ref, read) of every block of every row; starts are 0-based from the alignment's own.

    Different CIGARs are parsed once.
    """
    coded = cigars.dictionary_encode()
    parsed, first = [], [0]
    for text in coded.dictionary.to_pylist():
        ref = read = 0
        for size, op in _BLOCK.findall(text):
            parsed.append((ord(op), int(size), ref, read))
            ref += int(size) * (op in "MDN=X")
            read += int(size) * (op in "MIS=X")
        first.append(len(parsed))
    table, first = np.array(parsed, np.int64).reshape(-1, 4), np.array(first)
    code = coded.indices.to_numpy(zero_copy_only=False)
    sizes = first[code + 1] - first[code]
    row = np.repeat(np.arange(len(code)), sizes)
    return (row, *table[_ranges(first[code], sizes)].T)


_MISMATCH_CODE = np.full((256, 256), -1, np.int8)
for _i, (_x, _y) in enumerate(MISMATCHES):
    _MISMATCH_CODE[ord(_x), ord(_y)] = 3 + _i


def _events(batch: pa.RecordBatch, collapse: bool, min_base_quality: int) -> tuple[np.ndarray, ...]:
    """(row, measure, place, n): mutations of each alignment, and where its coverage begins and ends; places from 0."""
    seq, ref = Letters(batch.column("seq")), Letters(batch.column("_ref"))
    row, op, size, at_ref, at_read = cigar_blocks(batch.column("cigar"))
    aligned, gone, extra = np.isin(op, [ord(c) for c in "M=X"]), op == ord("D"), op == ord("I")

    # letters of aligned blocks
    inner = _ranges(np.zeros(aligned.sum(), np.int64), size[aligned])
    base_row = np.repeat(row[aligned], size[aligned])
    base_ref, base_read = inner + np.repeat(at_ref[aligned], size[aligned]), inner + np.repeat(at_read[aligned], size[aligned])
    own, other = seq.at(base_row, base_read), ref.at(base_row, base_ref)
    odd = own != other
    kinds, places, rows = [_MISMATCH_CODE[other[odd], own[odd]]], [base_ref[odd]], [base_row[odd]]
    starts = [base_ref[odd]]

    # deletions, moved 3' as long as the reference repeats itself, over the next block at most
    lost = np.flatnonzero(gone)
    behind = np.minimum(lost + 1, len(row) - 1)
    room = np.where((lost + 1 < len(row)) & (row[behind] == row[lost]), size[behind], 0) if len(lost) else np.zeros(0, np.int64)
    ahead, of = _ranges(np.zeros(len(lost), np.int64), room), np.repeat(np.arange(len(lost)), room)
    left = at_ref[lost][of] + ahead
    stops = ref.at(row[lost][of], left) != ref.at(row[lost][of], left + size[lost][of])
    shift = room.copy()
    np.minimum.at(shift, of[stops], ahead[stops])
    kinds.append(np.full(len(lost), 2, np.int8))
    starts.append(at_ref[lost] + shift)
    places.append(at_ref[lost] + shift + size[lost] - 1)
    rows.append(row[lost])

    kind, first, last, who = (np.concatenate(x) for x in (kinds, starts, places, rows))
    known = kind > 0
    if collapse and len(who):
        far = int(max(first.max(), last.max())) + 2
        known &= ~np.isin(who * far + last + 1, who * far + first)
    covered = aligned | gone
    out = [
        (who[known], kind[known], last[known], 1),
        (row[extra], 1, at_ref[extra] - 1, 1),
        (row[covered], 0, at_ref[covered], 1),
        (row[covered], 0, at_ref[covered] + size[covered], -1),
    ]
    if min_base_quality:
        quals = batch.column("qual")
        poor = (Letters(quals).at(base_row, base_read).astype(np.int64) - 33 < min_base_quality) & ~quals.is_null().to_numpy(zero_copy_only=False)[base_row]
        out += [(base_row[poor], 0, base_ref[poor], -1), (base_row[poor], 0, base_ref[poor] + 1, 1)]
    whole = [(r, np.broadcast_to(k, r.shape), p, np.broadcast_to(n, r.shape)) for r, k, p, n in out]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*whole))


_PILED = "design_idx bigint, tag string, measure string, pos int, n bigint"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(Letters(batch.column("seq")).size + Letters(batch.column("_ref")).size)
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_LETTERS, side="right"))
        b = min(max(b, a + 1), a + SLICE_ROWS)
        yield batch.slice(a, b - a)
        a = b


def _walk(collapse: bool, min_base_quality: int) -> Callable:
    """Alignments to summed events, a slice of bounded letters at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                row, measure, place, n = _events(part, collapse, min_base_quality)
                tags = part.column("tag").dictionary_encode(null_encoding="encode")
                designs = part.column("design_idx").to_numpy(zero_copy_only=False)
                own, tag = tags.indices.to_numpy(zero_copy_only=False), tags.dictionary
                groups, group = np.unique(np.stack([designs, own]), axis=1, return_inverse=True)
                pos = part.column("pos").to_numpy(zero_copy_only=False).astype(np.int64)[row] + place
                low = int(pos.min(initial=0))
                width = int(pos.max(initial=0)) - low + 1
                key, at = np.unique((group.reshape(-1)[row] * len(_MEASURES) + measure) * width + pos - low, return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, at.reshape(-1), n)
                key, total = key[total != 0], total[total != 0]
                of = groups[:, key // (width * len(_MEASURES))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(of[0], pa.int64()), tag.take(pa.array(of[1])).cast(pa.string()),
                    pa.array(_MEASURES[key // width % len(_MEASURES)].astype(object), pa.string()),
                    pa.array((key % width + low).astype(np.int32), pa.int32()), pa.array(total, pa.int64()),
                ], names=[f.split()[0] for f in _PILED.split(", ")])

    return run


def pileup(alignments: DataFrame, library: DataFrame, collapse: bool = True, min_length: int = 1,
           min_base_quality: int = 0, broadcast_letters: int = BROADCAST_LETTERS) -> DataFrame:
    """Counts (design_idx, pos, tag, measure, n) of alignments (read_id, tag, ref, pos, cigar, seq, qual).

    ``library`` has design_idx, name (the alignments' ref) and sequence.
    A deletion counts once, at its 3'-most possible last base. An insertion
    counts at the base before it. With ``collapse``, of directly adjacent
    mutations in a read only the 3'-most counts. Every base of an aligned or
    deleted stretch is covered once per read. Alignments without a place,
    CIGAR or sequence count nowhere.

    Alignments stay where they are read: a library of up to
    ``broadcast_letters`` letters goes to every task, a larger one is joined.
    They are walked side by side in arrays. One becomes its mutations, and
    +1/-1 where its coverage begins and ends, summed per slice before the
    shuffle, so a design most reads come from costs no more than one row per
    position and slice; the running sum over a design's positions gives the
    coverage.
    """
    refs = library.select("design_idx", F.col("name").alias("ref"), F.translate("sequence", "U", "T").alias("_ref"))
    keep = ["tag", "ref", "pos", "cigar", "seq"] + (["qual"] if min_base_quality else [])
    reads = alignments.select(*keep).where((F.length("seq") >= min_length) & F.col("pos").isNotNull() & F.col("cigar").isNotNull())
    letters = refs.agg(F.coalesce(F.sum(F.length("_ref") + F.length("ref")), F.lit(0))).first()[0]
    if letters <= broadcast_letters:
        joined = reads.join(F.broadcast(refs), "ref")
    else:
        joined = lookup_join(reads, refs, "ref", spread_by="seq", how="inner")
    # Only the stretch of the reference a read lies on is walked.
    joined = joined.select(
        F.col("design_idx").cast("bigint").alias("design_idx"), F.col("tag").cast("string").alias("tag"), F.col("pos").cast("int").alias("pos"),
        "cigar", "seq", *keep[5:], F.substring("_ref", F.col("pos"), reference_span(F.col("cigar"))).alias("_ref"),
    ).where("_ref IS NOT NULL")
    events = joined.mapInArrow(_walk(collapse, min_base_quality), _PILED).groupBy("design_idx", "tag", "measure", "pos").agg(F.sum("n").alias("n"))
    return _with_coverage(events)


def _with_coverage(events: DataFrame) -> DataFrame:
    """Turn changes of coverage into coverage at every position; other counts pass through.

    A window covers one design and tag: at most one row per position and measure.
    """
    step = F.col("measure") == _STEP
    line = Window.partitionBy("design_idx", "tag", step).orderBy("pos")
    depth = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = events.withColumns({"_depth": depth, "_next": F.lead("pos").over(line)})
    places = F.when(step, F.when(
        (F.col("_depth") > 0) & (F.col("_next") > F.col("pos")), F.sequence(F.col("pos"), F.col("_next") - 1)
    )).otherwise(F.array("pos"))
    return rows.select(
        "design_idx", F.explode(places).alias("pos"), "tag",
        F.when(step, COVERAGE).otherwise(F.col("measure")).alias("measure"),
        F.when(step, F.col("_depth")).otherwise(F.col("n")).alias("n"),
    )
