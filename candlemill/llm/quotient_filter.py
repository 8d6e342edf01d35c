"""Counting quotient filters of packed word-id n-grams.

An n-gram of up to three word ids is one number of three times the bits of an id
(a missing third word is 0). A keyed permutation of just so many bits, which can
be undone, spreads these numbers evenly. The leading bits name the filter (the
shard), the next ones are the quotient, the whole rest is the remainder, so the
filter loses nothing: bits tell which quotients occur and where the run of each
ends, remainders stand in whole bytes, and counts above 1 follow apart. Entries
are sorted by the permuted number, so filters are merged by merging.

Numbers are pairs of unsigned 64-bit arrays: the leading 63 bits (or all, if
fewer) and the bits behind them.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np

from candlemill.llm.common import mix

HIGH_BITS = 63
#: Most bits of a word id, so that both halves of a number fit in 63 bits.
MOST_ID_BITS = 42
_ROUNDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_HEADER = struct.Struct("<QBBBQQ")


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


class Permutation(NamedTuple):
    """Invertible mixing of packed ids of ``id_bits`` bits each."""

    id_bits: int

    @property
    def bits(self) -> int:
        return 3 * self.id_bits

    @property
    def high_bits(self) -> int:
        return min(HIGH_BITS, self.bits)

    @property
    def low_bits(self) -> int:
        return self.bits - self.high_bits

    def _rounds(self, left: np.ndarray, right: np.ndarray, order) -> tuple[np.ndarray, np.ndarray]:
        right_bits = self.bits // 2
        for k in order:
            if k % 2:
                right = right ^ (mix(left + _ROUNDS[k]) & _mask(right_bits))
            else:
                left = left ^ (mix(right + _ROUNDS[k]) & _mask(self.bits - right_bits))
        return left, right

    def forward(self, one: np.ndarray, two: np.ndarray, three: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of n-grams."""
        b, right_bits = self.id_bits, self.bits // 2
        of_two = np.uint64(right_bits - b)
        right = ((two & _mask(right_bits - b)) << np.uint64(b)) | three
        left = (one << np.uint64(2 * b - right_bits)) | (two >> of_two)
        left, right = self._rounds(left, right, (0, 1, 2, 3))
        if self.low_bits == 0:
            return (left << np.uint64(right_bits)) | right, np.zeros(len(left), np.uint64)
        cut = self.low_bits
        return (left << np.uint64(right_bits - cut)) | (right >> np.uint64(cut)), right & _mask(cut)

    def back(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of numbers."""
        b, right_bits, cut = self.id_bits, self.bits // 2, self.low_bits
        left = high >> np.uint64(right_bits - cut)
        right = ((high & _mask(right_bits - cut)) << np.uint64(cut)) | low
        left, right = self._rounds(left, right, (3, 2, 1, 0))
        two = ((left & _mask(2 * b - right_bits)) << np.uint64(right_bits - b)) | (right >> np.uint64(b))
        return left >> np.uint64(2 * b - right_bits), two, right & _mask(b)


class Entries(NamedTuple):
    """Numbers in order, each once, with their counts."""

    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    def between(self, first: int, last: int) -> Entries:
        return Entries(self.high[first:last], self.low[first:last], self.counts[first:last])


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> Entries:
    """Equal numbers together, in order."""
    if counts is None and not low.any():
        high, counts = np.unique(high, return_counts=True)
        return Entries(high, np.zeros(len(high), np.uint64), counts.astype(np.uint64))
    if counts is None:
        counts = np.ones(len(high), np.uint64)
    if not len(high):
        return Entries(high, low, counts)
    order = np.argsort(high, kind="stable")
    high, low = high[order], low[order]
    same = high[1:] == high[:-1]
    if (same & (low[1:] < low[:-1])).any():
        again = np.lexsort((low, high))
        high, low, order = high[again], low[again], order[again]
    starts = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    return Entries(high[starts], low[starts], np.add.reduceat(counts[order], starts))


def merged(parts: list[Entries]) -> Entries:
    """One from many: runs that are in order already are merged."""
    if len(parts) == 1:
        return parts[0]
    return counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _to_bytes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_bytes(raw: memoryview, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def encode(entries: Entries, bits: int, low_bits: int) -> bytes:
    """The filter of entries whose high part has ``bits`` bits that differ; the shard's bits are left out."""
    n = len(entries.high)
    high = entries.high & _mask(bits)
    # As many bits of quotient as there are entries, about; the remainder fills whole bytes.
    most = min(bits, n.bit_length() + 2)
    quotient = max(0, most - (most - bits) % 8)
    if (bits - quotient) % 8:
        quotient = bits % 8
    rest = bits - quotient
    quotients = high >> np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << quotient, bool)
    occupied[quotients.astype(np.int64)] = True
    run_ends = np.append(quotients[1:] != quotients[:-1], True) if n else np.zeros(0, bool)
    many = entries.counts > 1
    small = np.minimum(entries.counts[many], 255).astype(np.uint8)
    large = entries.counts[many][small == 255]
    low_width = -(-low_bits // 8)
    return b"".join(
        (
            _HEADER.pack(n, quotient, rest // 8, low_width, len(small), len(large)),
            np.packbits(occupied).tobytes(),
            np.packbits(run_ends).tobytes(),
            np.packbits(many).tobytes(),
            _to_bytes(high & _mask(rest), rest // 8),
            _to_bytes(entries.low, low_width),
            small.tobytes(),
            large.astype("<u8").tobytes(),
        )
    )


def decode(raw: bytes, shard: int, bits: int) -> Entries:
    """The entries of a filter, in order."""
    n, quotient, width, low_width, n_small, n_large = _HEADER.unpack_from(raw)
    view, at = memoryview(raw), _HEADER.size

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size : at]

    def flags(size: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(take(-(-size // 8)), np.uint8), count=size).astype(bool)

    occupied, run_ends, many = flags(1 << quotient), flags(n), flags(n)
    rest = _from_bytes(take(n * width), width, n)
    low = _from_bytes(take(n * low_width), low_width, n)
    small = np.frombuffer(take(n_small), np.uint8).astype(np.uint64)
    small[small == 255] = np.frombuffer(take(8 * n_large), "<u8")
    ends = np.flatnonzero(run_ends)
    quotients = np.repeat(np.flatnonzero(occupied).astype(np.uint64), np.diff(ends, prepend=-1))
    counts = np.ones(n, np.uint64)
    counts[many] = small
    high = rest
    if 8 * width < 64:
        high = high | (quotients << np.uint64(8 * width))
    return Entries(high | (np.uint64(shard) << np.uint64(bits) if bits < 64 else np.uint64(0)), low, counts)


def shards_of(entries: Entries, bits: int, shard_bits: int) -> list[tuple[int, Entries]]:
    """Entries by their leading ``shard_bits`` of ``bits`` bits; empty shards are left out."""
    if not len(entries.high):
        return []
    shard = (entries.high >> np.uint64(bits - shard_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    return [
        (int(shard[low]), entries.between(low, high))
        for low, high in zip(cuts.tolist(), np.append(cuts[1:], len(shard)).tolist(), strict=True)
    ]
