"""Elias-Fano coding of non-decreasing integers, with a select structure.

``n`` values below ``u`` take ``floor(log2(u / n))`` low bits each, packed, and
about two bits each for the high parts: the k-th value's high part h is the bit
at place ``h + k`` of a bit vector. Counts of ones before each block of 512 bits
(32-bit, 1/16 of a bit per bit) are the select structure: the k-th one is found
by a binary search over blocks and a scan of one block.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 64  # bytes
HEAD = struct.Struct("<IBxxxII")  # values, low bits, bytes of low parts, bytes of high parts
_AT_ONCE = 4096


def encode(values: np.ndarray) -> bytes:
    """``values``: non-decreasing, in [0, 2**63); at most 2**31 of them."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return HEAD.pack(0, 0, 0, 0)
    if (values[1:] < values[:-1]).any():
        raise ValueError("values must not decrease")
    width = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
    low = values & np.uint64((1 << width) - 1)
    # Low parts bit by bit, a byte of each at a time, so the bits of all values are never held at once.
    bits = np.empty((n, width), np.uint8)
    for k in range(width):
        bits[:, k] = (low >> np.uint64(k)) & np.uint64(1)
    lows = np.packbits(bits.reshape(-1), bitorder="little")
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high = np.zeros((int(places[-1]) // (8 * BLOCK) + 1) * 8 * BLOCK, np.uint8)
    high[places] = 1
    ones = high.reshape(-1, 8 * BLOCK).sum(axis=1, dtype=np.uint32)
    before = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
    highs = np.packbits(high, bitorder="little")
    return HEAD.pack(n, width, len(lows), len(highs)) + lows.tobytes() + highs.tobytes() + before.tobytes()


class EliasFano:
    """Reads values out of the coded bytes; nothing is decoded ahead of a question."""

    def __init__(self, data: bytes | memoryview):
        self.n, self.width, low, high = HEAD.unpack_from(data)
        self.lows = np.frombuffer(data, np.uint8, low, HEAD.size)
        self.highs = np.frombuffer(data, np.uint8, high, HEAD.size + low).reshape(-1, BLOCK)
        self.before = np.frombuffer(data, "<u4", len(self.highs), HEAD.size + low + high)
        #: Bytes that the coded values take.
        self.size = HEAD.size + low + high + 4 * len(self.highs)

    def select(self, ks: np.ndarray) -> np.ndarray:
        """The values at places ``ks`` (from 0), as int64."""
        ks = np.asarray(ks, np.int64)
        if len(ks) and not (0 <= ks.min() and ks.max() < self.n):
            raise IndexError("no such value")
        parts = [self._select(ks[a : a + _AT_ONCE]) for a in range(0, len(ks), _AT_ONCE)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _select(self, ks: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.before, ks, "right") - 1
        own, which = np.unique(block, return_inverse=True)
        # In each block asked for, the places of its ones: nonzero lists them block by block.
        ones = np.unpackbits(self.highs[own], axis=1, bitorder="little")
        _, place = np.nonzero(ones)
        first = np.cumsum(ones.sum(axis=1, dtype=np.int64)) - ones.sum(axis=1, dtype=np.int64)
        place = place[first[which] + ks - self.before[block]] + block * (8 * BLOCK)
        return ((place - ks) << self.width) | self._low(ks)

    def _low(self, ks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ks), np.int64)
        for k in range(self.width):
            at = ks * self.width + k
            out |= ((self.lows[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << k
        return out
