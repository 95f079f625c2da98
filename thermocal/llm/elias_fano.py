"""Elias-Fano lists: a non-decreasing integer sequence in about 2 + log2(u / n) bits a value.

Value i is split into ``low`` bits, packed one behind the other, and the rest, kept in
unary: bit ``(v >> low) + i`` of the upper bit string is set. ``select`` finds the i-th
set bit: a directory holds the position of every 256th set bit (32 bits each, relative
to a 64-bit base once per list), the words behind it are counted, and one byte is
searched. Bytes on disk: a header, the directory, the upper bits, the lower bits.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<4sBQQQQ")
_MAGIC = b"EFL1"
STEP = 256


def _pack(values: np.ndarray, width: int) -> bytes:
    if width == 0 or len(values) == 0:
        return b""
    bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def encode(values: np.ndarray) -> bytes:
    """The list as bytes. ``values``: non-negative, non-decreasing."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if n and (np.any(v[1:] < v[:-1]) or int(v[-1]) >> 62):
        raise ValueError("values must be non-decreasing and below 2**62")
    top = int(v[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    ones = (v >> np.uint64(low)) + np.arange(n, dtype=np.uint64)
    size = (int(ones[-1]) + 8) // 8 if n else 0
    upper = np.zeros(size, np.uint8)
    np.bitwise_or.at(upper, (ones >> np.uint64(3)).astype(np.int64), (1 << (ones & np.uint64(7))).astype(np.uint8))
    every = ones[::STEP]
    if len(every) and int(every[-1]) >> 32:
        raise ValueError("split the list: its upper bits pass 2**32")
    lower = b"".join(_pack(v[k:k + 65536] & np.uint64((1 << low) - 1), low) for k in range(0, n, 65536))
    return _HEAD.pack(_MAGIC, low, n, len(every), size, len(lower)) + every.astype("<u4").tobytes() + upper.tobytes() + lower


class EliasFano:
    """Reads an encoded list without unpacking it."""

    def __init__(self, data: bytes):
        magic, self.low, self.n, k, size, low_size = _HEAD.unpack_from(data)
        if magic != _MAGIC or len(data) != _HEAD.size + 4 * k + size + low_size:
            raise ValueError("not an Elias-Fano list")
        at = _HEAD.size
        self.every = np.frombuffer(data, "<u4", k, at)
        self.upper = np.frombuffer(data, np.uint8, size, at + 4 * k)
        self.lower = np.frombuffer(data, np.uint8, low_size, at + 4 * k + size)

    def __len__(self) -> int:
        return self.n

    def _low(self, i: int) -> int:
        at = i * self.low
        first, last = at >> 3, (at + self.low + 7) >> 3
        return (int.from_bytes(self.lower[first:last].tobytes(), "little") >> (at & 7)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.every[i // STEP])
        left = i % STEP  # set bits to pass from ``at`` on
        byte = at >> 3
        word = int(self.upper[byte]) & (0xFF << (at & 7))
        while left >= (c := word.bit_count()):
            left -= c
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left):
            word &= word - 1
        one = 8 * byte + (word & -word).bit_length() - 1
        return ((one - i) << self.low) | (self._low(i) if self.low else 0)

    def __iter__(self):
        """All values in order, a block of the upper bits at a time."""
        i, block = 0, 1 << 16
        for start in range(0, len(self.upper), block):
            bits = np.unpackbits(self.upper[start:start + block], bitorder="little")
            for one in np.flatnonzero(bits):
                if i >= self.n:
                    return
                yield ((int(one) + 8 * start - i) << self.low) | (self._low(i) if self.low else 0)
                i += 1
