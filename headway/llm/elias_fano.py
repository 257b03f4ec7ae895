"""Elias-Fano sequences in memory-mapped files, with vectorised successor search."""

from __future__ import annotations

import os

import numpy as np

_BYTE_SELECT = np.zeros((256, 8), np.uint8)  # place of the k-th set bit of a byte
for _b in range(256):
    for _k, _place in enumerate(p for p in range(8) if _b >> p & 1):
        _BYTE_SELECT[_b, _k] = _place

_1, _2, _4, _8, _BYTE = (np.uint64(k) for k in (1, 2, 4, 8, 0xFF))
CHUNK = 1 << 14  # so many are looked up at a time, in a core's cache
_EACH = np.uint64(0x0101010101010101)
_PAIRS, _FOURS, _LOW_HALVES, _TOPS = (_EACH * np.uint64(k) for k in (0x55, 0x33, 0x0F, 0x80))


def mapped(array: np.ndarray, folder: str, name: str) -> np.ndarray:
    """The array, written to a file and mapped read-only."""
    path = os.path.join(folder, name)
    array = np.ascontiguousarray(array)
    array.tofile(path)
    return np.memmap(path, array.dtype, "r", shape=array.shape) if array.size else array


def _chunks(n: int) -> list[slice]:
    return [slice(at, at + CHUNK) for at in range(0, n, CHUNK)]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts in unary, ranks of the words for select."""

    def __init__(self, values: np.ndarray, folder: str, name: str) -> None:
        values = values.astype(np.uint64)
        self.n = n = len(values)
        self.top = int(values[-1]) + 1 if n else 1
        self.low = low = min(56, max(0, (self.top // max(n, 1)).bit_length() - 1))  # read as part of eight bytes
        packed = [np.zeros(0, np.uint8)]
        for at in range(0, n, 1 << 16):  # a multiple of eight values fills whole bytes
            some = values[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(some, axis=1, count=low, bitorder="little")
            packed.append(np.packbits(bits.ravel(), bitorder="little"))
        self.lows = mapped(np.concatenate([*packed, np.zeros(8, np.uint8)]), folder, f"{name}.low")
        self.eights = np.ndarray(len(self.lows) - 7, "<u8", self.lows, strides=(1,))  # the eight bytes from each byte on
        high = (values >> np.uint64(low)).astype(np.int64)
        self.buckets = self.top >> low
        length = -(-(n + self.buckets + 2) // 64) * 64
        unary = np.zeros(length, np.uint8)
        unary[high + np.arange(n)] = 1
        raw = np.packbits(unary, bitorder="little")
        self.high = mapped(raw, folder, f"{name}.high")
        ones = np.bitwise_count(raw.view(np.uint64)).astype(np.int64)
        self.ones = mapped(np.concatenate([[0], np.cumsum(ones)]), folder, f"{name}.ones")
        self.zeros = mapped(64 * np.arange(len(ones) + 1) - self.ones, folder, f"{name}.zeros")

    def _select(self, want: np.ndarray, of: int) -> np.ndarray:
        """Place of the want-th (from 0) bit that equals ``of``."""
        rank = self.ones if of else self.zeros
        word = np.searchsorted(rank, want, side="right") - 1
        bits = self.high.view("<u8")[word]
        bits = bits if of else ~bits
        rest = (want - rank[word]).astype(np.uint64)
        # Ones of each byte, then of each byte and those below it, eight sums side by side in a word.
        ones = bits - (bits >> _1 & _PAIRS)
        ones = (ones & _FOURS) + (ones >> _2 & _FOURS)
        upto = ((ones + (ones >> _4)) & _LOW_HALVES) * _EACH
        full = np.bitwise_count((rest * _EACH | _TOPS) - upto & _TOPS).astype(np.uint64)  # bytes with no more than rest
        rest -= (upto << _8) >> (full * _8) & _BYTE
        place = _BYTE_SELECT[bits >> (full * _8) & _BYTE, rest]
        return word * 64 + full.astype(np.int64) * 8 + place

    def _next_zero(self, place: np.ndarray) -> np.ndarray:
        """The first bit from each place on that is not set."""
        free = ~self.high.view("<u8")[place >> 6] >> (place & 63).astype(np.uint64)
        out = place + np.bitwise_count((free & (~free + _1)) - _1)  # the bits below the lowest one of free
        far = np.flatnonzero(free == 0)  # none in the rest of the word
        out[far] = self._select(self.zeros[(place[far] >> 6) + 1], 0)
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), np.int64)
        bit = at * self.low
        return ((self.eights[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)).astype(np.int64)

    def every(self) -> np.ndarray:
        """The whole sequence."""
        at = np.arange(self.n)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - at
        return (high << self.low) | self._low(at)

    def get(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        for some in _chunks(len(at)):
            out[some] = ((self._select(at[some], 1) - at[some]) << self.low) | self._low(at[some])
        return out

    def successor(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First place in [begin, end) whose value is at least ``value`` (end: none)."""
        out = np.empty(len(value), np.int64)
        for some in _chunks(len(value)):
            out[some] = self._successor(value[some], begin[some], end[some])
        return out

    def _successor(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        bucket = np.minimum(value >> self.low, self.buckets)
        zero = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), 0), -1)
        first = zero - bucket + 1  # elements below this bucket
        after = self._next_zero(zero + 1) - bucket  # and in it
        at, stop = np.maximum(first, begin), np.minimum(after, end)
        low = value & ((1 << self.low) - 1)
        live = np.flatnonzero(at < stop)
        high = stop.copy()
        while len(live):  # halve what is left of the bucket
            middle = (at[live] + high[live]) >> 1
            less = self._low(middle) < low[live]
            at[live[less]] = middle[less] + 1
            high[live[~less]] = middle[~less]
            live = live[at[live] < high[live]]
        return np.minimum(at, end)
