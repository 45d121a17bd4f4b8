"""Words and word hashes of whole Arrow columns, computed without a Python loop over texts.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. All work is done on slices of a
batch of about ``SLICE_BYTES`` of text, so memory follows the slice (or one longer text), never
the batch, the partition or the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 22
BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit numbers, the same in every process."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, and where each row begins; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[where[0] : where[-1]], where - where[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, where = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(where, where[begin] + SLICE_BYTES, "right")) - 1
            end = max(begin + 1, end)
            yield batch.slice(begin, end - begin)
            begin = end


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; spans are disjoint, ascending and not empty."""
    return seeded_hashes(data, starts, ends, 0)[0]


def seeded_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, *seeds: int) -> np.ndarray:
    """Hashes of the byte spans in one pass, a row for each seed."""
    out = np.empty((len(seeds), len(starts)), np.uint64)
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + BLOCK_BYTES, "right")))
        s, lengths = starts[begin:end], ends[begin:end] - starts[begin:end]
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = data[place + np.repeat(s, lengths)].astype(np.uint64) + np.uint64(1)
        for number, seed in enumerate(seeds):
            sums = np.add.reduceat(values * multipliers(int(lengths.max()), seed)[place], first)
            out[number, begin:end] = mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        begin = end
    return out


class Words:
    """The words of each row: byte spans, and ``row_start[i]``, the first word of row i."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.where = text_bytes(column)
        if lower:
            self.data = LOWER[self.data]
        inside = ~IS_SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.where] = True
        before = np.ones(len(self.data), bool)
        after = np.ones(len(self.data), bool)
        if len(self.data):
            before[1:] = ~inside[:-1] | edge[1:-1]
            after[:-1] = ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.row_start = np.searchsorted(self.starts, self.where)
        self.made: dict[int, np.ndarray] = {}

    def make_hashes(self, *seeds: int) -> None:
        """Hash the words for all seeds at once, which costs less than one by one."""
        self.made |= zip(seeds, seeded_hashes(self.data, self.starts, self.ends, *seeds), strict=True)

    def hashes(self, seed: int = 0) -> np.ndarray:
        if seed not in self.made:
            self.make_hashes(seed)
        return self.made[seed]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row_start)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def gram_hashes(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hash of each ``size`` consecutive words, rows not regarded; shorter input gives none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(multipliers(size, seed)):
        total += hashes[i : i + n] * factor
    return mix(total)


def gram_places(row_start: np.ndarray, size: int) -> np.ndarray:
    """First words of the grams of ``size`` words that lie inside one row."""
    counts = np.maximum(np.diff(row_start) - size + 1, 0)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(first, counts) + np.repeat(row_start[:-1], counts)
