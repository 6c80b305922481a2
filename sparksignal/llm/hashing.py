"""Hashes of words and of runs of words, on whole arrays."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int):
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1 << 16)
            inverse = pow(_BASE, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(n - 1, _BASE, np.uint64), dtype=np.uint64)])
            self.down = np.concatenate([one, np.cumprod(np.full(n - 1, inverse, np.uint64), dtype=np.uint64)])
        return self.up, self.down


_powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Hashes of any runs of a sequence of numbers, from sums over its starts."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One number for each word; words hold no blanks."""
    parts = [np.zeros(0, np.uint64)]
    for at in range(0, len(words), 100_000):
        joined = np.frombuffer(b" ".join(words[at : at + 100_000]), np.uint8)
        blanks = np.flatnonzero(joined == 0x20)
        parts.append(Runs(joined)(np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(joined)]])))
    return np.concatenate(parts)
