"""Sets of word shingles as 64-bit hashes, for whole batches of texts at once.

Words are what bytes.split() parts, runs without the six ASCII white-space bytes, with A-Z lowered. A word's
hash is a sum over its bytes of a random value times a power for the place in the word, finished by a mixer;
a shingle's hash mixes those of its words in order. A text with fewer words than a shingle takes is one
shingle, of the words it has; a text without words has none.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _BASE, dtype=np.uint64))])
    return _POWERS


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes, one after another, and where each text's begin (and the last end)."""
    joined = b" ".join([b"", *texts, b""]).lower()
    raw = np.frombuffer(joined, dtype=np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    heads = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
    bounds = np.searchsorted(starts, heads)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    place = np.arange(len(raw), dtype=np.int64)
    lengths = np.diff(np.append(starts, len(raw)))
    place[starts[0] :] -= np.repeat(starts, lengths)
    place[: starts[0]] = 0
    values = _BYTE[raw]
    words = ends - starts
    powers = _powers(int(lengths.max()) + 1)
    values *= powers[place]
    return mix(np.add.reduceat(values, starts) + words.astype(np.uint64)), bounds


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in ascending order, one text after another, and where each text's begin."""
    hashed, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    n = len(hashed)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    left = bounds[1:][owner] - np.arange(n)  # words from here to the text's end
    whole = counts[owner] < words
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        use = left > k
        rolled = np.where(use, mix(rolled * np.uint64(0xD6E8FEB86659FD93) + np.roll(hashed, -k) + np.uint64(k + 1)), rolled)
    starting = np.where(whole, left == counts[owner], left >= words)
    values, of = rolled[starting], owner[starting]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[fresh], np.searchsorted(of[fresh], np.arange(len(texts) + 1))


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b| for ascending distinct values."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    places = np.searchsorted(large, small)
    places[places == len(large)] = 0
    both = int((large[places] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
