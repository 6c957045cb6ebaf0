"""Subword lattice: a word's probability, summed over all its segmentations into pieces of a vocabulary."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

#: Marks the start of a word in the vocabulary.
WORD_START = "▁".encode()
#: Words up to this many bytes (with the mark) are scored side by side, longer ones alone.
SIDE_BY_SIDE = 48

_BASE = 0xD6E8FEB86659FD93
_SUBSTITUTE = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a SentencePiece file as bytes, and their log-probabilities before any training.

    Where the file holds merge ranks for scores, as BPE files do, a piece of
    rank r gets a probability in proportion to 1 / (r + 1). Every single byte is
    a piece, so every word has a segmentation.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {}
    lowest = 0.0
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece, score = model.id_to_piece(i).encode(), model.get_score(i)
        scores[piece] = max(score, scores.get(piece, -math.inf))
        lowest = min(lowest, score)
    for b in range(256):
        scores.setdefault(bytes([b]), lowest)
    pieces = sorted(scores)
    given = np.array([scores[p] for p in pieces])
    if np.all(given == np.round(given)):  # ranks, not logarithms
        given = -np.log(1 - given)
    return pieces, given - np.logaddexp.reduce(given)


class Lattice:
    """All segmentations of words, weighted by the pieces' log-probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.log_p = np.asarray(log_p, np.float64)
        self.at = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], order
        self.may = np.zeros(1 << 22, bool)
        self.may[(hashes >> np.uint64(42)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * _BASE + int(_SUBSTITUTE[b])) % (1 << 64)
        return h

    def _arcs(self, words: np.ndarray) -> list[np.ndarray]:
        """For each length 1, 2, ...: piece ids at every start (words in rows), -1 for none."""
        n = words.shape[1]
        letters = _SUBSTITUTE[words]
        hashed, out = np.zeros((len(words), n + 1), np.uint64), []
        for size in range(1, min(n, self.longest) + 1):
            hashed = hashed[:, : n - size + 1] * np.uint64(_BASE) + letters[:, size - 1 :]
            flat = hashed.ravel()
            found = np.full(len(flat), -1, np.int64)
            some = np.flatnonzero(self.may[(flat >> np.uint64(42)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, flat[some]), len(self.keys) - 1)
            hit = self.keys[at] == flat[some]
            found[some[hit]] = self.ids[at[hit]]
            out.append(found.reshape(hashed.shape))
        return out

    def _weights(self, arcs: list[np.ndarray]) -> list[np.ndarray]:
        return [np.where(a >= 0, self.log_p[np.maximum(a, 0)], -np.inf) for a in arcs]

    @staticmethod
    def _forward(weights: list[np.ndarray], n: int) -> np.ndarray:
        """forward[:, j]: log-probability of the first j bytes, over all their segmentations."""
        forward = np.full((len(weights[0]), n + 1), -np.inf)
        forward[:, 0] = 0
        for end in range(1, n + 1):
            ways = np.stack([forward[:, end - s] + weights[s - 1][:, end - s] for s in range(1, min(end, len(weights)) + 1)])
            top = np.max(ways, axis=0)
            safe = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                forward[:, end] = safe + np.log(np.exp(ways - safe).sum(axis=0))
        return forward

    def _one(self, word: bytes) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        n, forward, arcs = len(word), None, []
        forward = np.full(n + 1, -np.inf)
        forward[0] = 0
        into: list[list[float]] = [[] for _ in range(n + 1)]
        for start in range(n):
            if start:
                top = max(into[start])
                forward[start] = top + math.log(sum(math.exp(x - top) for x in into[start]))
            here = []
            for size in range(1, min(self.longest, n - start) + 1):
                piece = self.at.get(word[start : start + size])
                if piece is not None:
                    here.append((size, piece))
                    into[start + size].append(forward[start] + self.log_p[piece])
            arcs.append(here)
        top = max(into[n])
        forward[n] = top + math.log(sum(math.exp(x - top) for x in into[n]))
        return forward, arcs

    def _groups(self, words: list[bytes]):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes[sizes <= SIDE_BY_SIDE]).tolist():
            own = np.flatnonzero(sizes == n)
            step = max(1, 400_000 // n)
            for a in range(0, len(own), step):
                part = own[a : a + step]
                yield part, np.frombuffer(b"".join(words[i] for i in part.tolist()), np.uint8).reshape(len(part), n)

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of each word's marginal probability; a word comes with its mark in front."""
        out = np.zeros(len(words))
        for part, letters in self._groups(words):
            out[part] = self._forward(self._weights(self._arcs(letters)), letters.shape[1])[:, -1]
        for i, word in enumerate(words):
            if len(word) > SIDE_BY_SIDE:
                out[i] = self._one(word)[0][-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each counted as often as ``counts`` says."""
        total = np.zeros(len(self.log_p))
        for part, letters in self._groups(words):
            n = letters.shape[1]
            arcs = self._arcs(letters)
            weights = self._weights(arcs)
            forward = self._forward(weights, n)
            # The backward sums are forward sums over the mirrored lattice.
            mirrored = [w[:, ::-1] for w in weights]
            backward = self._forward(mirrored, n)[:, ::-1]
            whole = forward[:, -1:]
            for size, (ids, weight) in enumerate(zip(arcs, weights), 1):
                row, start = np.nonzero(ids >= 0)
                share = np.exp(forward[row, start] + weight[row, start] + backward[row, start + size] - whole[row, 0])
                total += np.bincount(ids[row, start], share * counts[part][row], len(total))
        for i, word in enumerate(words):
            if len(word) > SIDE_BY_SIDE and counts[i]:
                forward, arcs = self._one(word)
                backward = np.full(len(word) + 1, -np.inf)
                backward[-1] = 0
                for start in range(len(word) - 1, -1, -1):
                    ways = [self.log_p[p] + backward[start + size] for size, p in arcs[start]]
                    top = max(ways)
                    if top > -math.inf:
                        backward[start] = top + math.log(sum(math.exp(x - top) for x in ways))
                    for size, p in arcs[start]:
                        total[p] += counts[i] * math.exp(forward[start] + self.log_p[p] + backward[start + size] - forward[-1])
        return total
