"""Hashes of words and word shingles for whole texts, without a Python loop over words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK_BYTES = 1 << 20
# An odd base has an inverse modulo 2^64, so a word's hash is a difference of prefix sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def cumulative(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return cumulative(_BASE), cumulative(_INVERSE)


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def _block_words(block: np.ndarray) -> np.ndarray:
    gap = _SEPARATOR[block]
    edge = np.diff(np.concatenate(([True], gap, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = BLOCK_BYTES + 1
    while size <= len(block):
        size *= 2
    powers, inverses = _powers(size)
    sums = np.zeros(len(block) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[block].astype(np.uint64) + np.uint64(1)) * powers[: len(block)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of UTF-8 text, A-Z lower-cased; long texts go in blocks cut at separators."""
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) <= BLOCK_BYTES:
        return _block_words(data)
    found, start = [], 0
    while start < len(data):
        end = min(start + BLOCK_BYTES, len(data))
        while end < len(data) and not _SEPARATOR[data[end]]:
            end += 1
        found.append(_block_words(data[start:end]))
        start = end
    return np.concatenate(found)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words; fewer words are one run, no words none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    value = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        value = value * np.uint64(_BASE) + words[i : i + len(value)]
    return mix(value)
