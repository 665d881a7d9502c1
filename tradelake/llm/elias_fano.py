"""Elias-Fano coding of ascending numbers with a select structure."""

from __future__ import annotations

import struct

import numpy as np

#: Every this many set bits of the upper part, the position of one is kept.
SAMPLE = 256

_HEAD = struct.Struct("<QQB")


class EliasFano:
    """Ascending non-negative numbers in about ``2 + log2(largest / count)`` bits each.

    The low bits of a number are packed as they are; its high part is a run of zeros
    closed by a one, so that the number at place ``i`` is found from the position of
    the ``i``-th one. Sampled positions (32 bits per 256 numbers) start that search.
    """

    def __init__(self, count: int, largest: int, upper: np.ndarray, lower: np.ndarray, samples: np.ndarray) -> None:
        self.count, self.largest = count, largest
        self.low_bits = self.width(count, largest)
        self.upper, self.lower, self.samples = upper, lower, samples

    @staticmethod
    def width(count: int, largest: int) -> int:
        """Bits kept of each number as they are."""
        return max(0, (largest // count).bit_length() - 1) if count else 0

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count = len(values)
        largest = int(values[-1]) if count else 0
        low = cls.width(count, largest)
        ones = (values >> low) + np.arange(count)
        bits = np.zeros(((int(ones[-1]) + 1 if count else 0) + 7) // 8 * 8, np.uint8)
        bits[ones] = 1
        lows = (values[:, None] >> np.arange(low)) & 1
        samples = ones[::SAMPLE].astype("<u4")
        return cls(
            count, largest, np.packbits(bits, bitorder="little"),
            np.packbits(lows.astype(np.uint8).ravel(), bitorder="little"), samples,
        )

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.count, self.largest, self.low_bits) + b"".join(
            struct.pack("<Q", part.nbytes) + part.tobytes() for part in (self.upper, self.lower, self.samples)
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, largest, _ = _HEAD.unpack_from(data)
        at, parts = _HEAD.size, []
        for kind in ("u1", "u1", "<u4"):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 8))
            at += 8 + size
        return cls(count, largest, *parts)

    def select(self, place: int) -> int:
        """The number at ``place``."""
        return int(self.range(place, place + 1)[0])

    def range(self, first: int, last: int) -> np.ndarray:
        """The numbers at places ``first`` up to but without ``last``."""
        if not 0 <= first <= last <= self.count:
            raise IndexError(f"{first}:{last} of {self.count}")
        if first == last:
            return np.zeros(0, np.int64)
        block = first // SAMPLE
        begin = int(self.samples[block]) // 8
        after = -(-last // SAMPLE)
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.upper)
        bits = np.unpackbits(self.upper[begin:end], bitorder="little")
        bits[: int(self.samples[block]) - begin * 8] = 0  # ones of the block before
        ones = np.flatnonzero(bits)[first - block * SAMPLE :][: last - first] + begin * 8
        high = ones - np.arange(first, last)
        if not self.low_bits:
            return high
        from_bit, to_bit = first * self.low_bits, last * self.low_bits
        lows = np.unpackbits(self.lower[from_bit // 8 : -(-to_bit // 8)], bitorder="little")
        lows = lows[from_bit % 8 :][: to_bit - from_bit].reshape(-1, self.low_bits).astype(np.int64)
        return (high << self.low_bits) | (lows << np.arange(self.low_bits)).sum(1)
