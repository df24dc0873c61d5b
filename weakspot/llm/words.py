"""Words of many texts at once, as 64-bit numbers.

A word is a run of bytes between white space; its number is a polynomial of
its bytes modulo 2^64, mixed. Two given words share a number with a
probability of about 2^-64. Everything is a few NumPy passes over the bytes,
so no Python object is made per word.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C55  # odd, so that powers have inverses
KEPT = (1 << 20) + (1 << 16)
_POWERS = [np.ones(1, dtype="uint64"), np.ones(1, dtype="uint64")]

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over all 64 (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables of a usual piece are kept, longer ones are not."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    made = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(max(n, KEPT), base, dtype="uint64")
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= KEPT:
        _POWERS[:] = made
    return made[0][:n], made[1][:n]


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each range of values, by itself: what stands around a row
    does not change a bit of its sum."""
    out = np.zeros(len(bounds) - 1)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(np.asarray(values, dtype="float64"), bounds[:-1][full])
    return out


class Words:
    """``codes`` of all words in order; text i has ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: list[bytes], space: np.ndarray = SPACE):
        joined = b" ".join(texts) + b" "
        self.bytes = np.frombuffer(joined, dtype="uint8")
        ends_at = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype="int64")
        gap = space[self.bytes]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.bounds = np.concatenate([[0], np.searchsorted(self.starts, ends_at)]).astype("int64")

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """The sum of a per-byte value over each word, modulo 2^64."""
        total = np.empty(len(per_byte) + 1, dtype="uint64")
        total[0] = 0
        np.cumsum(per_byte, out=total[1:])
        return total[self.ends] - total[self.starts]

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        data = self.bytes if data is None else data
        power, inverse = _powers(len(data) + 1)
        return mix(self.sums((data.astype("uint64") + np.uint64(1)) * power[:len(data)]) * inverse[self.starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of texts that are lower-cased already, bounds."""
    words = Words(texts)
    return words.hashes(), words.bounds
