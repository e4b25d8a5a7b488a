"""Vectorised names of words and of windows, by polynomials modulo 2^64."""

from __future__ import annotations

import numpy as np

from .common import mix

_P, _Q = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_rng = np.random.Generator(np.random.PCG64(7))
#: A fixed 64-bit value per byte; the second table has the same for a letter A-Z and its lower case.
BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        have = _powers[base] = tuple(
            np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, b, np.uint64))) for b in (base, inverse)
        )
    return have[0][:n], have[1][:n]


def spans(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int = _P) -> np.ndarray:
    """A name of each run ``values[start:stop]``, the same wherever the run stands."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[stop] - total[start]) * down[start]


def words(raw: np.ndarray, at: np.ndarray, table: np.ndarray = BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts (``raw`` bytes, starting ``at``): where words start and stop, the text and the name of each."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~SPACES[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    begins = inside[1:] & (~inside[:-1] | edge)
    ends = inside[:-1] & (~inside[1:] | edge)
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
    text = np.searchsorted(at, start, side="right") - 1
    return start, stop, text, mix(spans(table[raw], start, stop))


def windows(names: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names and 32-bit checks of the windows of ``size`` names that start at ``start``."""
    a = mix(spans(names, start, start + size, _Q))
    b = mix(spans(mix(names), start, start + size, _P))
    return a, (b >> np.uint64(32)).astype(np.uint32)
