"""Polynomial hashes of text ranges, for many texts at once.

The prefix hash of a buffer is a running sum of ``code[byte] * base**i`` modulo
2**64; the hash of any range is a difference of two of them, scaled to start at
power zero.  Everything is NumPy over the bytes of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes of text that are hashed at a time; a longer text is taken by itself.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _codes(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & _MASK))


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, CHUNK + 1)
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (BASE, _INVERSE)
            )
        return self.up, self.down


class Prefix:
    """Prefix hashes of one buffer."""

    def __init__(self, data: np.ndarray, powers: Powers, seed: int = 1):
        up, self.down = powers.upto(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_codes(seed)[data] * up[: len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all ranges of this size."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first..last`` with their bytes and where each of them starts.

    ``texts`` has no nulls.  The starts have one entry more than there are rows.
    """
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, data[ends[first] : ends[last]], (ends[first : last + 1] - ends[first]).astype(np.int64)
        first = last


def number_views(column: pa.Array) -> list[np.ndarray]:
    """Arrays of 64-bit numbers kept as binary values, without copying."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return [np.frombuffer(data, np.uint64, (b - a) // 8, a) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def word_spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of marked bytes, runs ending with rows."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    first = inside & (~before | edge[:n])
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = inside & (~after | edge[1:])
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(starts, begin, "right") - 1


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return word_spans(~_SPACE[data], starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, powers: Powers, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles of lower-cased words.

    A row with fewer words has its whole sequence as one shingle.
    """
    begin, end, row = words(data, starts)
    rows = len(starts) - 1
    if not len(begin):
        return [np.zeros(0, np.uint64)] * rows
    prefix = Prefix(FOLD[data], powers)
    word = mixed(prefix.ranges(begin, end) + (end - begin).astype(np.uint64))
    place = [np.uint64(pow(BASE, k + 1, 1 << 64)) for k in range(size)]
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])
    n = len(word)
    full = np.zeros(0, np.uint64)
    whose = np.zeros(0, np.int64)
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total += word[k : n - size + 1 + k] * place[k]
        same = row[: n - size + 1] == row[size - 1 :]
        full, whose = mixed(total[same]), row[: n - size + 1][same]
    few = np.flatnonzero((count > 0) & (count < size))
    short = np.zeros(len(few), np.uint64)
    for k in range(size - 1):
        have = count[few] > k
        short[have] += word[first[few[have]] + k] * place[k]
    short = mixed(short + count[few].astype(np.uint64))
    every, whose = np.concatenate([full, short]), np.concatenate([whose, few])
    order = np.lexsort((every, whose))
    every, whose = every[order], whose[order]
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:] != every[:-1]) | (whose[1:] != whose[:-1])
    every, whose = every[fresh], whose[fresh]
    return np.split(every, np.searchsorted(whose, np.arange(1, rows)))
