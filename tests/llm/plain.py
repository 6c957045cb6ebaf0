"""Plain versions of the operators, row by row, for small inputs."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_phrases(text):
    words = WORD.findall(fold(text))
    at = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    places = [i for i, _ in at]
    return (len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, codes, radius=3):
    """Smallest id each reaches over pairs of codes within the radius."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    smallest = {}
    for i, x in enumerate(ids):
        smallest[find(i)] = min(x, smallest.get(find(i), x))
    return [smallest[find(i)] for i in range(len(ids))]


def repeats(rows, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256 of what is left)} of rows (doc_id, text), by all windows."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        left = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def base_scores(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    cut = {d: re.findall(r"[^\x20\x09-\x0D]+", fold(t)) + [None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    counts = Counter(w for d, words in cut.items() if not held[d] for w in words)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (held[d], len(words), sum(counts[w] > 0 for w in words), n,
            sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        for d, words in cut.items()
    }


def digest(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
