"""Prefix polynomial hashes modulo 2^64 over numpy arrays.

The prefix sums of value * base^position give the hash of any span in constant time,
the same wherever the span stands. Callers verify what such a hash finds equal.
"""

from __future__ import annotations

import numpy as np

_BASES = {"bytes": 0x9E3779B97F4A7C15, "words": 0xD1342543DE82EF95}
_POWERS: dict[tuple[int, int], np.ndarray] = {}
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get((base, 0))
    if held is None or len(held) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        held = _POWERS[base, 0] = np.cumprod(grown)
    return held[:n]


class Spans:
    """Hashes of spans of one array of values."""

    def __init__(self, values: np.ndarray, kind: str):
        base = _BASES[kind]
        self.back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * _powers(base, len(values)), out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (self.sums[stops] - self.sums[starts]) * self.back[starts]

    def every(self, length: int) -> np.ndarray:
        """Of every span of that length."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.back[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """h with all bits spread over all bits; one to one."""
    h = h ^ (h >> np.uint64(30))
    h *= M1
    h ^= h >> np.uint64(27)
    h *= M2
    h ^= h >> np.uint64(31)
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width values, by doubling."""
    out, done = h, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out
