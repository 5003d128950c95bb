"""Hashes of words and of runs of words, over whole texts, as array operations."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))])
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of bytes without ASCII white space) of a UTF-8 text."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = _SPACE[raw]
    edges = np.diff(space.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    up, down = _BYTES.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTER[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hashes(words: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the ``length`` words from each position (of ``at``, or all that fit)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    if at is None:
        at = np.arange(n)
    return mix((sums[at + length] - sums[at]) * down[at])
