"""Elias-Fano coding of non-decreasing integers, with select.

n values below u take n * floor(log2(u / n)) low bits, packed, and at most 2 n + u / 2^low high bits in unary. Select
finds the i-th one of the unary part through the positions of every 256th one, kept as 32-bit counts, and a popcount
scan of at most a few words; no table of 64-bit offsets exists on disk or in memory.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBxxxxxxxQQ")


def _pack(values: np.ndarray, width: int) -> bytes:
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)).astype(np.uint8) & 1
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def _unpack(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The values at the given places of a packed array."""
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64) * width
    first = bit >> 3
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.zeros(len(at), np.uint64)
    shift = (bit & 7).astype(np.uint64)
    for k in range((width + 14) // 8):
        byte = padded[first + k].astype(np.uint64)
        moved = np.where(np.uint64(8 * k) >= shift, byte << (np.uint64(8 * k) - np.minimum(shift, np.uint64(8 * k))), byte >> (shift - np.minimum(np.uint64(8 * k), shift))) if k == 0 else byte << (np.uint64(8 * k) - shift)
        out |= moved
    return out & np.uint64((1 << width) - 1)


class EliasFano:
    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high = n, universe, low_bits, low, high
        words = np.concatenate([high, np.zeros(-len(high) % 8, np.uint8)]).view("<u8")
        self.words = words
        ones = np.bitwise_count(words).astype(np.uint32)
        self.rank = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        # the word in which every SAMPLE-th one lies
        self.samples = (np.searchsorted(self.rank, np.arange(0, n, SAMPLE, dtype=np.uint32), side="right") - 1).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("values must not decrease")
        if n >= 1 << 32:
            raise ValueError("one structure holds fewer than 2**32 values; write more shards")
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low = np.frombuffer(_pack(values & np.uint64((1 << low_bits) - 1), low_bits), np.uint8)
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(place[-1]) + 1 if n else 0) + 1, np.uint8)
        bits[place] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little"))

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        word = int(self.samples[i // SAMPLE])
        while self.rank[word + 1] <= i:
            word += 1
        bits, left = int(self.words[word]), i - int(self.rank[word])
        for _ in range(left):
            bits &= bits - 1
        place = word * 64 + (bits & -bits).bit_length() - 1
        low = int(_unpack(self.low, np.array([i]), self.low_bits)[0])
        return (place - i) << self.low_bits | low

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Values start to stop - 1; only the words that hold them are looked at."""
        if start >= stop:
            return np.zeros(0, np.uint64)
        first, last = (int(np.searchsorted(self.rank, i, side="right")) - 1 for i in (start, stop - 1))
        ones = np.flatnonzero(np.unpackbits(self.words[first : last + 1].view(np.uint8), bitorder="little"))
        place = ones[start - int(self.rank[first]) :][: stop - start] + 64 * first
        at = np.arange(start, stop)
        return (place - at).astype(np.uint64) << np.uint64(self.low_bits) | _unpack(self.low, at, self.low_bits)

    def all(self) -> np.ndarray:
        """All values in order."""
        place = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (place - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return high | _unpack(self.low, np.arange(self.n), self.low_bits)

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.n, self.universe, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> tuple[EliasFano, int]:
        """The structure and the number of bytes it took."""
        n, universe, low_bits, low_size, high_size = _HEAD.unpack_from(data)
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, low_size, at)
        high = np.frombuffer(data, np.uint8, high_size, at + low_size)
        return cls(n, universe, low_bits, low, high), at + low_size + high_size
