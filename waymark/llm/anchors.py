"""Content-defined anchors of fixed-length byte strings.

Every string of ``length`` bytes holds length - gram + 1 grams; its anchor is the leftmost gram of least hash.
Equal strings have their anchors at equal places, so a string can only occur again where its anchor's gram
does. Anchors of neighbouring strings mostly coincide: a text has about two for each length - gram bytes.
"""

from __future__ import annotations

import numpy as np

from waymark.llm.shingles import mix

_RNG = np.random.default_rng(41)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPAN = 1 << 16
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * SPAN, _BASE, dtype=np.uint64))])
_INVERSES = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * SPAN, _INVERSE, dtype=np.uint64))])


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place, by differences of prefix sums, over spans of bounded size."""
    n = len(raw) - gram + 1
    out = np.empty(max(n, 0), dtype=np.uint64)
    for start in range(0, n, SPAN):
        part = raw[start : min(len(raw), start + SPAN + gram - 1)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * _POWERS[: len(part)], out=sums[1:])
        here = len(part) - gram + 1
        out[start : start + here] = (sums[gram:] - sums[:here]) * _INVERSES[:here]
    return mix(out)


#: Low bits of a hash that give way to its place, so that a least value tells where it is; ties go to the left.
PLACE_BITS = 20
_PLACES = np.uint64((1 << PLACE_BITS) - 1)


def window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """The place of the leftmost least hash of each window, by prefix and suffix minima of blocks."""
    count = len(hashes) - window + 1
    out = np.empty(count, dtype=np.int64)
    step = (1 << PLACE_BITS) - window
    for start in range(0, count, step):
        part = hashes[start : start + step + window - 1]
        n = len(part)
        padded = np.full(-(-n // window) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:n] = (part & ~_PLACES) | np.arange(n, dtype=np.uint64)
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        here = n - window + 1
        least = np.minimum(behind[:here], ahead[window - 1 : window - 1 + here])
        out[start : start + here] = (least & _PLACES).astype(np.int64) + start
    return out


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, their grams, and the first and last start of the strings that each is the anchor of.

    Grams are hashes mixed once more: as least hashes of windows they would all be small.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return empty, empty.astype(np.uint64), empty, empty
    hashes = gram_hashes(raw, gram)
    places = window_minima(hashes, length - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    last = np.append(first[1:], len(places)) - 1
    return places[first], mix(hashes[places[first]] + np.uint64(1)), first, last
