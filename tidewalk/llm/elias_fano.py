"""Elias-Fano coding of non-decreasing integers, with select by sampled positions.

A value is split into ``low_bits`` low bits, packed as they are, and the rest, written
in unary into one bit vector; n values below u take about ``n * (2 + log2(u / n))``
bits.  The i-th value needs the place of the i-th one in that vector: the places of
every 256th are kept as 32-bit numbers, and a popcount scan does the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 256
#: Values whose low bits are packed at once, a multiple of 8 so that parts end with a byte.
PACKED = 1 << 13


@dataclass(frozen=True)
class EliasFano:
    n: int
    low_bits: int
    low: np.ndarray  # uint8, packed bits
    high: np.ndarray  # uint8, packed bits
    samples: np.ndarray  # uint32

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values`` are non-decreasing and not negative."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        if np.any(values[1:] < values[:-1]):
            raise ValueError("values must not decrease")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        if ones[-1] >= 1 << 32:
            raise ValueError("too many values for one structure; write more files")
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = [np.zeros(0, np.uint8)]
        for at in range(0, n, PACKED):
            bits = (values[at : at + PACKED, None] >> shifts) & np.uint64(1)
            low.append(np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little"))
        return cls(n, low_bits, np.concatenate(low), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), dtype=np.uint64)
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def select(self, i: int) -> int:
        """The i-th value, from the samples and a scan of few bytes."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, word = at >> 3, int(self.high[at >> 3]) >> (at & 7) << (at & 7)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return (one - i) << self.low_bits | int(self._low(np.array([i]))[0])

    def select_range(self, i: int, j: int) -> np.ndarray:
        """Values i to j - 1, as int64: the sample before the i-th says where to start, and only the bytes up to the j-th are unpacked."""
        j = min(j, self.n)
        if i >= j:
            return np.zeros(0, np.int64)
        first = i // SAMPLE
        begin = int(self.samples[first]) >> 3
        # The sample after the last value bounds its place.
        after = -(-j // SAMPLE)
        end = (int(self.samples[after]) >> 3) + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + 8 * begin
        ones = ones[ones >= int(self.samples[first])][i - first * SAMPLE : j - first * SAMPLE]
        at = np.arange(i, j)
        return (((ones - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)).astype(np.int64)

    def decode(self) -> np.ndarray:
        """All values, as int64."""
        if self.n == 0:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return (((ones - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)).astype(np.int64)

    def parts(self) -> dict[str, bytes]:
        return {"low": self.low.tobytes(), "high": self.high.tobytes(), "samples": self.samples.astype("<u4").tobytes()}

    @classmethod
    def of_parts(cls, n: int, low_bits: int, parts: dict[str, bytes]) -> EliasFano:
        return cls(n, low_bits, np.frombuffer(parts["low"], np.uint8), np.frombuffer(parts["high"], np.uint8), np.frombuffer(parts["samples"], "<u4"))
