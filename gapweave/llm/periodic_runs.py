"""Periodic runs of words, found by internal pattern matching in each text.

A run is a stretch of consecutive words of a text with smallest period q (words q apart are
identical) and at least ``max(LEAST, TIMES * q)`` words, which no neighbouring word extends.

The words of a text are named by prefix doubling: ``ranks[k][i]`` is the same for equal sequences of 2^k
words, and the last order of the positions is the suffix array, in which the occurrences of every
dyadic block are a range. A wavelet matrix over the suffix array answers range successor queries:
the first occurrence of a block at or after a place.

For each block length b = 8, 16, 32 ... every aligned block asks for its occurrences that start b to 2b - 1
words later (the shortest also for those 1 to 7 words later). In a stretch of 2b words the
occurrences of b words form an arithmetic progression:

* one or two of them: their distances from the block are candidate periods;
* three or more: the block has a small period d itself, the difference of the progression. The
  stretch of period d around the block and that around the occurrence begin, or end, a candidate
  period apart.

A run of period q holds, for the largest b <= q (8 if q is smaller), an aligned block and its repetition q
words on, so that no run is missed: one end of a stretch of period d lies inside the run, or q wouldn't be its
smallest period. Candidates are extended to both sides by the dyadic names, longest first, and a stretch
that several periods give has the smallest of them. The whole is O(n log n) for n words.

Texts in which no 8 words occur twice have no run and go no further than the comparison of the
hashes of all 8 words; beyond that, names stand for words exactly, not for hashes.

Spark: one pass, no shuffle; texts are worked off in slices of about 4 MB and ``CHUNK_WORDS`` words or one
longer text. A text of n words takes about 10 n log2(n) bytes in its task.

Defined cases: a null or empty text has no words and no run; a very long text is searched as a
whole; rows that repeat are searched row by row; an empty table gives no rows; other columns than
key and text are not read, whatever their names. Ties: runs are sorted by start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.recompression import kept_texts
from gapweave.llm.shared import on_workers
from gapweave.llm.words import Words, gram_hashes, gram_places, mix, slices

LEAST = 24
TIMES = 3
#: words of the shortest dyadic block; LEAST holds an aligned one and its repetition up to 8 words later
BASE_LEVEL = 3
BASE = 1 << BASE_LEVEL
CHUNK_WORDS = 1 << 18

RUNS = "array<struct<start: long, length: long, period: long>>"


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """For each key the place of its first equal in sorted order; the order; whether all keys differ."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return rank, order, bool(new.all())


class DyadicNames:
    """Names of all sequences of 2^k words of the rows, and the suffix array. Rows share no names."""

    def __init__(self, words: np.ndarray, row_start: np.ndarray):
        n = len(words)
        row = np.repeat(np.arange(len(row_start) - 1), np.diff(row_start))
        self.begin, self.end = row_start[:-1][row], row_start[1:][row]
        rank, order, distinct = ranked(row * (int(words.max(initial=0)) + 1) + words)
        places = np.arange(n)
        self.ranks = [np.append(rank, -1).astype(np.int32)]
        step = 1
        while not distinct:
            follows = places + step < self.end
            second = np.where(follows, rank[np.where(follows, places + step, 0)] + 1, 0)
            rank, order, distinct = ranked(rank * (n + 1) + second)
            self.ranks.append(np.append(rank, -1).astype(np.int32))
            step *= 2
        self.suffixes = order

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from i and j > i on."""
        i, j, first = i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][i] == self.ranks[k][j]
            i[same] += 1 << k
            j[same] += 1 << k
        return i - first

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree before i and j > i."""
        begin, i, j, first = self.begin[i], i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            inside = i - (1 << k) >= begin
            same = inside & (self.ranks[k][np.where(inside, i - (1 << k), 0)] == self.ranks[k][np.where(inside, j - (1 << k), 0)])
            i[same] -= 1 << k
            j[same] -= 1 << k
        return first - i


class WaveletMatrix:
    """Order statistics of ranges of an array that holds 0 to n - 1."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.levels = []
        for bit in range(max(1, (self.size - 1).bit_length()) - 1, -1, -1):
            one = (values >> bit) & 1
            before = np.append(0, np.cumsum(one)).astype(np.int32)
            self.levels.append((bit, before, self.size - int(before[-1])))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def count_below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at left .. right - 1 are below ``bound`` (at most the size)."""
        beyond = bound >= self.size
        bound, count = np.where(beyond, 0, bound), np.zeros(len(left), np.int64)
        whole = right - left
        for bit, ones, zeros in self.levels:
            l1, r1 = ones[left], ones[right]
            up = (bound >> bit) & 1 == 1
            count += np.where(up, (right - r1) - (left - l1), 0)
            left, right = np.where(up, zeros + l1, left - l1), np.where(up, zeros + r1, right - r1)
        return np.where(beyond, whole, count)

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value that has ``nth`` smaller ones at left .. right - 1; the size where there are no more."""
        missing = nth >= right - left
        nth, found = np.where(missing, 0, nth), np.zeros(len(left), np.int64)
        for bit, ones, zeros in self.levels:
            l1, r1 = ones[left], ones[right]
            low = (right - r1) - (left - l1)
            up = nth >= low
            nth = np.where(up, nth - low, nth)
            found |= up.astype(np.int64) << bit
            left, right = np.where(up, zeros + l1, left - l1), np.where(up, zeros + r1, right - r1)
        return np.where(missing, self.size, found)


def candidates(names: DyadicNames, matrix: WaveletMatrix, level: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs from the aligned blocks of 2^level words and occurrences ``nearest`` words on or more."""
    b = 1 << level
    n = len(names.begin)
    rank = names.ranks[level][:-1]
    places = np.arange(n)
    blocks = np.flatnonzero(((places - names.begin) % b == 0) & (places + b <= names.end))
    size = np.bincount(rank, minlength=n)
    blocks = blocks[size[rank[blocks]] > 1]
    left = rank[blocks].astype(np.int64)
    right = left + size[left]
    stop = np.minimum(blocks + (2 * b if nearest >= b else b), n)
    nth = matrix.count_below(left, right, blocks + nearest)
    first, second, third = (matrix.smallest(left, right, nth + i) for i in range(3))
    found = [first < stop, second < stop, third < stop]
    few = ~found[2]
    one, two, many = few & found[0], few & found[1], found[2]
    if nearest < b:  # the distance of the next occurrence is the only period that a run around the block can have
        one, two, many = found[0], np.zeros(len(blocks), bool), np.zeros(len(blocks), bool)
    p, e, d = blocks[many], first[many], (second - first)[many]
    begins = (e - names.backward(e, e + d)) - (p - names.backward(p, p + d))
    ends = (e + names.forward(e, e + d)) - (p + names.forward(p, p + d))
    place = np.concatenate([blocks[one], blocks[two], p, p])
    period = np.concatenate([(first - blocks)[one], (second - blocks)[two], begins, ends])
    fine = (period > 0) & (place + period < names.end[place])
    return place[fine], period[fine]


def runs_of(words: np.ndarray, row_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of all rows, by start and period; ``words`` are small numbers."""
    nothing = np.zeros(0, np.int64)
    if not len(words):
        return nothing, nothing, nothing
    names = DyadicNames(words, row_start)
    if len(names.ranks) - 1 < BASE_LEVEL:
        return nothing, nothing, nothing
    matrix = WaveletMatrix(names.suffixes)
    asked = [(BASE_LEVEL, 1), *[(k, 1 << k) for k in range(BASE_LEVEL, len(names.ranks))]]
    pairs = [candidates(names, matrix, level, nearest) for level, nearest in asked]
    place, period = (np.concatenate(x) for x in zip(*pairs, strict=True))
    _, pick = np.unique(np.stack([place, period]), axis=1, return_index=True)
    place, period = place[pick], period[pick]
    back = names.backward(place, place + period)
    start, length = place - back, back + period + names.forward(place, place + period)
    fine = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = start[fine], length[fine], period[fine]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)  # of the periods of one stretch, the smallest
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def word_numbers(words: Words, pick: np.ndarray) -> np.ndarray:
    """Small numbers, equal for equal words."""
    starts, size = words.starts[pick], (words.ends - words.starts)[pick]
    ends = np.cumsum(size)
    data = words.data[np.arange(int(size.sum())) + np.repeat(starts - (ends - size), size)]
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
    spelled = pa.Array.from_buffers(pa.large_binary(), len(size), [None, offsets, pa.py_buffer(data)])
    return np.asarray(spelled.dictionary_encode().indices).astype(np.int64)


def rows_with_repeats(words: Words) -> np.ndarray:
    """Rows in which some BASE words occur twice, by their hashes."""
    places = gram_places(words.row_start, BASE)
    row = words.rows()[places]
    grams = gram_hashes(words.hashes(), BASE)[places] ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(grams)
    twice = order[1:][grams[order][1:] == grams[order][:-1]]
    return np.unique(row[twice])


def chunks(rows: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in groups of about CHUNK_WORDS words."""
    if len(rows):
        group = np.cumsum(counts[rows]) // CHUNK_WORDS
        yield from np.split(rows, np.flatnonzero(np.diff(group)) + 1)


def search(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs, starts counted in the words of the whole slice."""
    found = []
    for rows in chunks(rows_with_repeats(words), words.counts):
        counts = words.counts[rows]
        where = np.append(0, np.cumsum(counts))
        pick = np.arange(where[-1]) + np.repeat(words.row_start[rows] - where[:-1], counts)
        start, length, period = runs_of(word_numbers(words, pick), where)
        found.append((np.searchsorted(where, start, "right") - 1, pick[start], length, period, rows))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    row = np.concatenate([rows[own] for own, *_, rows in found])
    return row, *(np.concatenate([x[i] for x in found]) for i in (1, 2, 3))


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        words = Words(part.column("text"))
        row, start, length, period = search(words)
        steps = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(steps, start + period, 1)
        np.add.at(steps, start + length, -1)
        keep = np.cumsum(steps[:-1]) == 0
        spans = pa.StructArray.from_arrays(
            [pa.array(start - words.row_start[row]), pa.array(length), pa.array(period)], ["start", "length", "period"]
        )
        offsets = np.searchsorted(row, np.arange(part.num_rows + 1))
        runs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(words.counts), runs, kept_texts(words, keep)],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length and period in words) and ``collapsed``.

    ``collapsed`` is the text without the words that a run holds after its first period, joined by one blank.
    """
    on_workers(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run_rows, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
