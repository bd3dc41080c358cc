"""Elias-Fano sequences: a non-decreasing integer sequence in near-minimal space.

Each value keeps its low bits verbatim and its high part in unary in a bit
vector with one set bit per value; ``n * (2 + log2(u / n))`` bits in all. The
select structure stores the place of every 256th set bit, so that one value is
found by counting bits in a few bytes after a sample.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class EliasFano:
    """Bit vectors of one sequence; ``get`` decodes one value, ``between`` some in a row."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.high, self.low, self.samples = n, low_bits, high, low, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values``: non-negative and non-decreasing."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
        bits[ones] = 1
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(low.astype(np.uint8).ravel(), bitorder="little"),
                   ones[::SAMPLE].astype(np.uint32 if n and ones[-1] < 2 ** 32 else np.uint64))

    def select(self, i: int) -> int:
        """Place of the i-th set bit of the high bit vector."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        left += int(_ONES[int(self.high[byte]) & ((1 << place % 8) - 1)])  # set bits before the sample in its byte
        while left >= (c := int(_ONES[self.high[byte]])):
            left -= c
            byte += 1
        bits = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
        return byte * 8 + int(bits[left])

    def get(self, i: int) -> int:
        low = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            low |= (int(self.low[at // 8]) >> at % 8 & 1) << k
        return (self.select(i) - i) << self.low_bits | low

    def between(self, lo: int, hi: int) -> np.ndarray:
        """Values ``lo`` to ``hi - 1``: two selects bound the bytes that hold them."""
        if lo >= hi:
            return np.zeros(0, np.int64)
        first, last = self.select(lo) // 8, self.select(hi - 1) // 8
        ones = np.flatnonzero(np.unpackbits(self.high[first:last + 1], bitorder="little")) + first * 8
        at = int(np.searchsorted(ones, self.select(lo)))
        out = (ones[at:at + hi - lo] - np.arange(lo, hi)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            begin, end = lo * self.low_bits, hi * self.low_bits
            bits = np.unpackbits(self.low[begin // 8:-(-end // 8)], bitorder="little")[begin % 8:begin % 8 + end - begin]
            bits = bits.reshape(hi - lo, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out.astype(np.int64)

    def all(self) -> np.ndarray:
        return self.between(0, self.n)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIIQQ", self.n, self.low_bits, self.samples.itemsize, len(self.high), len(self.low))
        return head + self.high.tobytes() + self.low.tobytes() + self.samples.astype(f"<u{self.samples.itemsize}").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> EliasFano:
        n, low_bits, width, n_high, n_low = struct.unpack_from("<QIIQQ", data)
        at = struct.calcsize("<QIIQQ")
        high = np.frombuffer(data, np.uint8, n_high, at)
        low = np.frombuffer(data, np.uint8, n_low, at + n_high)
        return cls(n, low_bits, high, low, np.frombuffer(data, f"<u{width}", -(-n // SAMPLE), at + n_high + n_low))
