"""Winnowed anchors: of every window of a sequence the least hashed gram, so that equal windows have
equal anchors at equal places.

A sequence is an array of 64-bit unit hashes (bytes or words).  Consecutive windows with the same
anchor make one block: the anchor's gram hash, a hash of all units of the block, and the block's place.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Windows of longer sequences are taken in segments of so many units.
SEGMENT = 1 << 19
_PLACE_BITS = 20
_POWERS: dict[int, np.ndarray] = {}

#: Hash of a byte.
BYTE_UNITS = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = 1 << max(12, (n - 1).bit_length())
        got = np.full(size, base, np.uint64)
        got[0] = 1
        _POWERS[base] = got = np.multiply.accumulate(got)
    return got[:n]


def _sums(units: np.ndarray) -> np.ndarray:
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _powers(_BASE, len(units)), out=out[1:])
    return out


def blocks(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``gram_hash, block_hash`` (signed 64 bits), ``start`` of the first window, number of windows,
    and the anchor's place after the start, for each block of the sequence."""
    parts = []
    with np.errstate(over="ignore"):
        for a in range(0, max(1, len(units) - window + 1), SEGMENT):
            part = units[a:a + SEGMENT + window - 1]
            if len(part) >= window:
                g, b, s, n, o = _segment(part, window, gram)
                parts.append((g, b, s + a, n, o))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _segment(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    sums, n = _sums(units), len(units)
    hashes = mixed((sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n - gram + 1))
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)         # leftmost among equals
    width, have = window - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least & mask).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, len(place)])
    at = place[first]
    end = first + count - 1 + window
    whole = mixed((sums[end] - sums[first]) * _powers(_INVERSE, n)[first] + (at - first).astype(np.uint64))
    return hashes[at].view(np.int64), whole.view(np.int64), first, count, at - first
