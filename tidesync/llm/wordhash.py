"""Hashes of words and word windows over many texts at once (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20                      # bytes hashed at a time
_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of what ``a`` and ``b`` hash."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(33))) * np.uint64(0xA0761D6478BD642F))


def _segments(data: bytes) -> Iterator[bytes]:
    """The text in parts of about SEGMENT bytes, cut at whitespace."""
    at = 0
    while at < len(data):
        end = at + SEGMENT
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each whitespace-separated word (ASCII whitespace) of UTF-8 bytes, in order."""
    parts = []
    for segment in _segments(data):
        raw = np.frombuffer(segment, np.uint8)
        space = np.empty(len(raw) + 2, bool)
        space[0] = space[-1] = True
        space[1:-1] = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1])
        start, end = edge[0::2], edge[1::2]
        if not len(start):
            continue
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _powers(_MULT, len(raw)), out=total[1:])
        own = (total[end] - total[start]) * _powers(_INVERSE, len(raw) + 1)[start]
        parts.append(mix(own + (end - start).astype(np.uint64)))
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive words, by doubling."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    have, span = words, 1
    while 2 * span <= width:
        have, span = combine(have[:-span], have[span:]), 2 * span
    if span < width:                   # two overlapping halves cover the rest
        have = combine(have[:len(have) - (width - span)], have[width - span:])
    return have


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of each ``width`` consecutive values."""
    at, span = np.arange(len(values)), 1

    def smaller(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] < values[left], right, left)

    while 2 * span <= width:
        at, span = smaller(at[:-span], at[span:]), 2 * span
    if span < width:
        at = smaller(at[:len(at) - (width - span)], at[width - span:])
    return at
