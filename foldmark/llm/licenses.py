"""Licence scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import keyed_texts, raw_texts, text_slices
from .license_rules import Rule, default_rules

# ASCII that is no letter or digit separates words; A-Z are lower-cased; bytes of other characters are kept.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

DETECTIONS = pa.list_(pa.struct([
    ("label", pa.string()), ("rule", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("priority", pa.int32()), ("confidence", pa.float64()), ("protected", pa.bool_()),
]))
SCHEMA = ("doc_id bigint, n_words bigint, detections array<struct<label:string,rule:string,first_word:bigint,"
          "last_word:bigint,priority:int,confidence:double,protected:boolean>>")


class Scanner:
    """Compiled rules, found by their anchor word."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        # Words share their separating blanks, so a match is looked for ahead of its first blank.
        self.patterns = [re.compile(rb"(?= (" + r.pattern.encode() + rb") )") for r in rules]
        self.by_anchor: dict[bytes, list[int]] = defaultdict(list)
        for n, r in enumerate(rules):
            self.by_anchor[r.anchor.encode()].append(n)
        self.anchors = frozenset(self.by_anchor)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (rule, first word, last word) of what is left after suppression."""
        words = text.translate(_FOLD).split()
        hit = self.anchors.intersection(words)
        if not hit:
            return len(words), []
        line = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        found = []
        for n in sorted(n for a in hit for n in self.by_anchor[a]):
            spans = [m.span(1) for m in self.patterns[n].finditer(line)]
            if spans:
                at = np.array(spans)
                found.append(np.column_stack([
                    np.full(len(at), n), np.searchsorted(blanks, at[:, 0]) - 1, np.searchsorted(blanks, at[:, 1]) - 1,
                ]))
        return len(words), self._resolved(np.concatenate(found)) if found else []

    def _resolved(self, found: np.ndarray) -> list[tuple[int, int, int]]:
        """Drop what lies inside a kept detection of a higher priority, or inside a longer one of its own.

        Of equal spans of one priority the rule that is listed first stays.
        """
        free = np.array([self.rules[n].protected for n in found[:, 0]], bool)
        kept = [tuple(map(int, x)) for x in found[free]]
        rest = found[~free]
        level = np.array([self.rules[n].priority for n in rest[:, 0]], np.int64)
        starts, reach = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for priority in sorted(set(level.tolist()), reverse=True):
            own = rest[level == priority]
            own = own[np.lexsort((own[:, 0], -own[:, 2], own[:, 1]))]
            before = np.concatenate([[-1], np.maximum.accumulate(own[:, 2])[:-1]])
            own = own[own[:, 2] > before]
            if len(starts):
                at = np.searchsorted(starts, own[:, 1], side="right") - 1
                own = own[~((at >= 0) & (reach[np.maximum(at, 0)] >= own[:, 2]))]
            kept += [tuple(map(int, x)) for x in own]
            both = np.concatenate([starts, own[:, 1]])
            ends = np.concatenate([reach, own[:, 2]])
            order = np.argsort(both, kind="stable")
            starts, reach = both[order], np.maximum.accumulate(ends[order]) if len(order) else ends
        return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence detections of every document: doc_id, n_words and the detections, by their words from 0.

    Whole texts are scanned, each in the task that reads it; nothing is
    shuffled. A rule's regular expression runs only on documents that hold its
    anchor word. Null and empty texts have no words and no detections; a null
    id stays null; repeated rows are scanned each; other columns are ignored.
    """
    rules = default_rules() if rules is None else rules

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in text_slices(batches):
            counts, out = [], []
            for text in raw_texts(batch.column("text")):
                n, found = scanner.scan(text)
                counts.append(n)
                out.append([
                    {"label": r.label, "rule": r.name, "first_word": a, "last_word": z, "priority": r.priority,
                     "confidence": r.confidence, "protected": r.protected}
                    for r, a, z in ((scanner.rules[k], a, z) for k, a, z in found)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(out, DETECTIONS)],
                names=["doc_id", "n_words", "detections"],
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)
