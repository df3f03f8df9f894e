"""Hashes of all words of a text at once."""

from __future__ import annotations

from functools import cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype="uint64") * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        held = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 17), base)], dtype="uint64")
        _powers[int(base)] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes, separators: np.ndarray = SPACES, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each run of bytes that aren't separators, in order; start and end are byte offsets."""
    b = np.frombuffer(data, dtype="uint8")
    if lower:
        b = _LOWER[b]
    inside = np.r_[False, ~separators[b], False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    sums = np.r_[np.uint64(0), np.cumsum(_TABLE[b] * powers(_BASE, len(b)), dtype="uint64")]
    h = (sums[ends] - sums[starts]) * powers(_BACK, len(b) + 1)[starts]
    return mix(h ^ (ends - starts).astype("uint64")), starts, ends


@cache
def _factors(places: tuple[int, ...], salt: int) -> np.ndarray:
    return np.random.default_rng([salt, *places]).integers(1, 2**63, len(places), dtype="uint64") * np.uint64(2) + np.uint64(1)


def spaced(h: np.ndarray, places: tuple[int, ...], salt: int) -> np.ndarray:
    """For each position, a hash of the words at the given places after it; the last place sets the span."""
    n = len(h) - places[-1]
    if n <= 0:
        return np.zeros(0, dtype="uint64")
    total = np.zeros(n, dtype="uint64")
    for place, factor in zip(places, _factors(places, salt), strict=True):
        total += h[place : place + n] * factor
    return mix(total)
