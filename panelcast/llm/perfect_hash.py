"""A minimal perfect hash in numpy: levels of bit arrays, a key lives in the first level where it is alone."""

from __future__ import annotations

import struct

import numpy as np

ROOM = 1.5  # bits per key and level


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
    return (_mix(high + step) ^ _mix(low ^ step)) % np.uint64(size)


def build(high: np.ndarray, low: np.ndarray) -> bytes:
    """Function of the distinct 128-bit keys ``(high, low)`` onto 0 .. n - 1."""
    with np.errstate(over="ignore"):
        levels, left, level = [], np.arange(len(high)), 0
        while len(left):
            size = max(8, int(ROOM * len(left)) + 1)
            at = _places(high[left], low[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(struct.pack("<Q", size) + np.packbits(alone).tobytes())
            left, level = left[~alone[at]], level + 1
    return struct.pack("<I", len(levels)) + b"".join(levels)


def find(function: bytes, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Index of each key; -1 for keys that fall through all levels (others get any index)."""
    index = np.full(len(high), -1, np.int64)
    left, at, before = np.arange(len(high)), 4, 0
    with np.errstate(over="ignore"):
        for level in range(struct.unpack_from("<I", function)[0]):
            size = struct.unpack_from("<Q", function, at)[0]
            n_bytes = (size + 7) // 8
            alone = np.unpackbits(np.frombuffer(function, np.uint8, n_bytes, at + 8))[:size]
            at += 8 + n_bytes
            rank = np.cumsum(alone)
            place = _places(high[left], low[left], level, size)
            hit = alone[place] == 1
            index[left[hit]] = before + rank[place[hit]] - 1
            left, before = left[~hit], before + int(rank[-1])
    return index
