"""64-bit hashes of words and of word shingles, computed for many texts at once with numpy.

A text's bytes are mapped to random numbers, multiplied by powers of an odd base and added up; the hash of a
word is the difference of two running sums, scaled back to the word's start. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes that separate words, and the two families of hash constants.
BLANK = bytes([9, 10, 11, 12, 13, 32])
BASE = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES = 1 << 20

RANDOM = np.random.default_rng(20260).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each bit of the hash over the others."""
    h = (h ^ (h >> np.uint64(32))) * FOLD
    h = (h ^ (h >> np.uint64(29))) * BASE
    return h ^ (h >> np.uint64(32))


def powers_to(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for n, base in enumerate((BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[n] = np.cumprod(steps, dtype=np.uint64)
    return _powers


class Words:
    """The words of texts given as UTF-8 bytes: ``hashes`` of all words in order, ``starts`` of texts in it."""

    def __init__(self, texts: list[bytes], breaks: bytes = BLANK):
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        is_break = np.zeros(256, bool)
        is_break[list(breaks)] = True
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        gap = is_break[data]
        gap[np.cumsum(lengths) - 1] = True
        before = np.concatenate(([True], gap[:-1])) if len(gap) else gap
        first = np.flatnonzero(before & ~gap)
        last = np.flatnonzero(gap & ~before)
        up, down = powers_to(len(data) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(RANDOM[lower[data]] * up[: len(data)], dtype=np.uint64)))
        self.first, self.last, self.sums, self.down = first, last, sums, down
        self.hashes = mix((sums[last] - sums[first]) * down[first])
        self.starts = np.searchsorted(first, np.concatenate(([0], np.cumsum(lengths))))

    def beginnings(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word."""
        return mix((self.sums[np.minimum(self.last, self.first + size)] - self.sums[self.first]) * self.down[self.first])

    def shingles(self, size: int) -> Iterator[np.ndarray]:
        """For each text the hashes of its runs of ``size`` words; a shorter text is one run."""
        h = self.hashes
        runs = h.copy()
        for step in range(1, size):
            runs[: len(h) - step] = runs[: len(h) - step] * FOLD + h[step:]
        runs = mix(runs + np.uint64(size))
        for start, end in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            if end - start >= size:
                yield runs[start : end - size + 1]
            elif end > start:
                whole = h[start : start + 1].copy()
                for n in range(start + 1, end):
                    whole = whole * FOLD + h[n]
                yield mix(whole + np.uint64(end - start))
            else:
                yield runs[:0]


def in_chunks(texts: list[bytes | None], most: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Texts in order, in lists of bounded size (or of one longer text)."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def shingle_sets(texts: list[bytes | None], size: int, breaks: bytes = BLANK) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    for chunk in in_chunks(texts):
        for runs in Words(chunk, breaks).shingles(size):
            yield np.unique(runs)
