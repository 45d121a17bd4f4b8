"""Removal of repeated passages by recompression.

A text's words are named by hash, and rounds rename them: first runs of one word, then pairs. In
a pair round every symbol belongs to a left or a right side, chosen by its name; a left symbol
followed by a right one becomes a new symbol, named by the two names. Names depend on content
alone, so equal passages get equal symbols wherever they stand, but for their borders: with every
symbol goes the span of words that decided on it, and a symbol whose deciding span lies in a
passage is found in each copy of it.

Spark compares the symbols of all documents, in two sorts:

* small symbols (a few words): a window of words can only be found elsewhere if every small symbol
  that it decides on is. All other windows drop out before any window is moved;
* large symbols (``LARGE`` words or more, made from smaller ones): one that a smaller document holds
  too proves all windows in it repeated, at once.

The windows left, mostly at the borders of long repeats, are compared by their own names.

A name has 64 bits, and the rounds hash one name into the next. What proves a repeat, a large symbol or a window, is verified: Spark
compares it by its name and by a check, 32 bits more, made of other hashes of all its words and not of the rounds. Of 10^13
windows, about 0.001 pairs in all are expected to agree in these 96 bits by chance. Names of small
symbols only choose which windows are compared, so two with one name cost a comparison and change no result.

Skew: equal texts are found first, by an aggregated digest, and only the smallest document of
them takes part. Of the documents in a slice of a task (some MB of text) that hold a name, those between the smallest and the
largest have a smaller and a larger document there already; only the two at the ends are compared with other slices, so the
group of a name that all documents hold has two rows a slice, and the rows in between are spread over all tasks. What is found
is gathered by id and digest, so a list belongs to one text, also where a third of all rows have one id; a
name in all texts of such an id at the end of a slice is compared once for each of them. A text is moved once, to
its document's partition.

Defined cases: a null or empty text has no words; a null id counts as smaller than all; rows that
repeat an id are judged one by one, against smaller ids only; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gapweave.llm.shared import on_workers, written
from gapweave.llm.words import Words, gram_hashes, gram_places, mix, multipliers, slices

WINDOW = 13
SMALL_ROUNDS = (1, 2, 3)
SMALL_WORDS = 3
LARGE_FACTOR = 2
ROUNDS = 18
NULL_ID = -(1 << 63)
SALTS = 1 << 20
CHECK_SEED = 3


@dataclass
class Symbols:
    """Symbols in text order: name, row, words [begin, end), deciding words [low, high]."""

    name: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def take(self, which: np.ndarray) -> Symbols:
        return Symbols(*(x[which] for x in (self.name, self.row, self.begin, self.end, self.low, self.high)))


def of_words(hashes: np.ndarray, rows: np.ndarray) -> Symbols:
    place = np.arange(len(hashes))
    return Symbols(hashes, rows, place, place + 1, place, place)


def far(window: int, s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Deciding spans of the left and right neighbours; a text's edge is out of any window's reach."""
    n = len(s.name)
    low, high = s.begin - window - 1, s.end + window + 1
    if n > 1:
        joined = s.row[1:] == s.row[:-1]
        low[1:] = np.where(joined, s.low[:-1], low[1:])
        high[:-1] = np.where(joined, s.high[1:], high[:-1])
    return low, high


def name_runs(s: Symbols, window: int) -> Symbols:
    """Each maximal run of one symbol becomes a symbol."""
    n = len(s.name)
    if not n:
        return s
    low, high = far(window, s)
    same = np.zeros(n, bool)
    same[1:] = (s.row[1:] == s.row[:-1]) & (s.name[1:] == s.name[:-1])
    first = np.flatnonzero(~same)
    last = np.append(first[1:], n) - 1
    length = (last - first + 1).astype(np.uint64)
    name = np.where(length > 1, mix(s.name[first] * np.uint64(3) + length * multipliers(1, 5)[0]), s.name[first])
    return Symbols(
        name,
        s.row[first],
        s.begin[first],
        s.end[last],
        np.minimum(low[first], s.low[first]),
        np.maximum(high[last], s.high[last]),
    )


def name_pairs(s: Symbols, number: int, window: int, large: int) -> tuple[Symbols, np.ndarray]:
    """Left symbols and the right ones after them become symbols; which of the new ones did."""
    n = len(s.name)
    if n < 2:
        return s, np.zeros(n, bool)
    key, factor = multipliers(2, 7 + number)
    left = (mix(s.name ^ key) >> np.uint64(63)).astype(bool)
    small = s.end - s.begin < large
    made = np.zeros(n, bool)
    made[:-1] = left[:-1] & ~left[1:] & (s.row[1:] == s.row[:-1]) & small[:-1] & small[1:]
    gone = np.zeros(n, bool)
    gone[1:] = made[:-1]
    low, high = far(window, s)
    alone = small & ~made & ~gone
    new = Symbols(
        s.name.copy(),
        s.row,
        s.begin,
        s.end.copy(),
        np.where(alone & ~left, np.minimum(low, s.low), s.low),
        np.where(alone & left, np.maximum(high, s.high), s.high),
    )
    at = np.flatnonzero(made)
    new.name[at] = mix(s.name[at] * factor + s.name[at + 1])
    new.end[at] = s.end[at + 1]
    new.low[at] = np.minimum(s.low[at], s.low[at + 1])
    new.high[at] = np.maximum(s.high[at], s.high[at + 1])
    kept = np.flatnonzero(~gone)
    return new.take(kept), made[kept]


def recompress(hashes: np.ndarray, rows: np.ndarray, window: int) -> tuple[Symbols, Symbols]:
    """The small and the large symbols of each row."""
    large = LARGE_FACTOR * window
    s = name_runs(of_words(hashes, rows), window)
    small: list[Symbols] = []
    for number in range(ROUNDS):
        before = len(s.name)
        s, made = name_pairs(s, number, window, large)
        if number in SMALL_ROUNDS:
            few = made & (s.end - s.begin >= SMALL_WORDS) & (s.high - s.low < window)
            small.append(s.take(few))
        elif number > SMALL_ROUNDS[-1] and len(s.name) == before:
            break
    pick = np.flatnonzero(s.end - s.begin >= large)
    joined = Symbols(*(np.concatenate([getattr(x, f) for x in small]) for f in Symbols.__dataclass_fields__))
    return joined, s.take(pick)


def checks(words: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 bits for each span of words, from other word hashes: of polynomials in an odd number, modulo 2 ** 64."""
    hashes = words.hashes(CHECK_SEED)
    base = multipliers(1, CHECK_SEED)[0]
    powers = np.full(len(hashes) + 1, base, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    # the same words have the same sum anywhere once it is raised to the power of the slice's last word
    shifted = (sums[end] - sums[begin]) * powers[len(hashes) - begin]
    whole = mix(shifted * inverse_power(base, len(hashes)) + (end - begin).astype(np.uint64))
    return (whole >> np.uint64(32)).astype(np.uint32)


def inverse_power(base: np.uint64, exponent: int) -> np.uint64:
    """``base`` ** -``exponent`` modulo 2 ** 64."""
    return np.uint64(pow(int(base), -exponent, 1 << 64))


def within(names: np.ndarray, rows: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which names are in the list of their row (an array column of longs)."""
    size = np.asarray(lists.value_lengths().fill_null(0))
    listed = np.asarray(lists.flatten()).view(np.uint64)
    owner = np.repeat(np.arange(len(size)), size).astype(np.uint64)
    salt = multipliers(1, 99)[0]
    return np.isin(names ^ mix(rows.astype(np.uint64) * salt), listed ^ mix(owner * salt))


def windows_covered(count: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """How many of the intervals [first, last] hold each place."""
    fine = first <= last
    steps = np.bincount(np.maximum(first[fine], 0), minlength=count + 1)[: count + 1].astype(np.int64)
    ends = np.bincount(np.minimum(last[fine] + 1, count), minlength=count + 1)[: count + 1]
    return np.cumsum(steps - ends)[:count]


def copies_left_out(batch: pa.RecordBatch) -> np.ndarray:
    """Rows whose text a smaller document has too."""
    return np.asarray(
        [bool(c) and d in c for d, c in zip(batch.column("digest").to_pylist(), batch.column("copies").to_pylist(), strict=True)],
        dtype=bool,
    )


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


NAMED = "name long, doc long, tag long, salt long"  # in this order zeros lie together, and shuffles are smaller


def named_rows(part: pa.RecordBatch, names: np.ndarray, check: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """(name, doc, tag, salt) of a slice, once a row.

    The tag has the check in its upper half. Documents between the smallest and the largest of the slice that hold the name
    with this check know their answer: their tag is odd and has the salt too, so their groups stay small.
    """
    doc, salt = part.column("doc").to_numpy(), part.column("salt").to_numpy()
    rank = np.empty(len(doc), np.int64)
    by_doc = np.lexsort((salt, doc))
    rank[by_doc] = np.arange(len(doc))
    order = np.lexsort((rank[rows], check, names))
    names, check, rows = names[order], check[order], rows[order]
    other = np.ones(len(names), bool)
    other[1:] = (names[1:] != names[:-1]) | (check[1:] != check[:-1])
    new = other.copy()
    new[1:] |= rows[1:] != rows[:-1]
    names, check, rows = names[new], check[new], rows[new]
    doc, salt = doc[rows], salt[rows]
    first = np.flatnonzero(other[new])
    size = np.diff(np.append(first, len(names)))
    inner = (np.repeat(doc[first], size) < doc) & (doc < np.repeat(doc[first + size - 1], size))
    tag = (check.astype(np.uint64) << np.uint64(32)) | np.where(inner, 2 * salt + 1, 0).astype(np.uint64)
    columns = [as_long(names), pa.array(doc), as_long(tag), pa.array(np.where(inner, 0, salt))]
    return pa.RecordBatch.from_arrays(columns, ["name", "doc", "tag", "salt"])


def symbol_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            part = part.filter(pa.array(~copies_left_out(part)))
            words = Words(part.column("text"))
            words.make_hashes(0, CHECK_SEED)
            small, large = recompress(words.hashes(), words.rows(), window)
            name, row = (np.concatenate([getattr(small, f), getattr(large, f)]) for f in ("name", "row"))
            check = np.append(np.zeros(len(small.name), np.uint32), checks(words, large.begin, large.end))
            yield named_rows(part, name, check, row)

    return run


def judged(part: pa.RecordBatch, window: int, choose: bool = True):
    """For a slice: words, places and names of the windows, which are proven, and, to ``choose``, which others are to be compared."""
    words = Words(part.column("text"))
    words.make_hashes(0, *[CHECK_SEED] * choose)
    hashes = words.hashes()
    small, large = recompress(hashes, words.rows(), window)
    n = len(hashes)
    places = gram_places(words.row_start, window)
    has = within(large.name, large.row, part.column("earlier"))
    proven = windows_covered(n, large.begin[has], large.end[has] - window)[places] > 0
    fits = np.zeros(len(places), bool)
    if choose:
        reach = (small.high - window + 1, small.low)
        all_small = windows_covered(n, *reach)
        for column in ("earlier", "later"):
            has = within(small.name, small.row, part.column(column))
            fits |= (windows_covered(n, reach[0][has], reach[1][has]) == all_small)[places]
    return words, places, gram_hashes(hashes, window)[places], proven, fits


def window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            part = part.filter(pa.array(~copies_left_out(part)))
            words, places, names, proven, fits = judged(part, window)
            pick = np.flatnonzero(fits & ~proven)
            row = np.searchsorted(words.row_start, places[pick], "right") - 1
            yield named_rows(part, names[pick], checks(words, places[pick], places[pick] + window), row)

    return run


def cleaned_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, places, names, proven, _ = judged(part, window, choose=False)
            row = np.searchsorted(words.row_start, places, "right") - 1
            hit = proven | within(names, row, part.column("repeats")) | copies_left_out(part)[row]
            n = len(words.starts)
            gone = windows_covered(n, places[hit], places[hit] + window - 1) > 0
            texts = kept_texts(words, ~gone)
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.row_start[:-1])
            removed[words.counts == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(words.counts), pa.array(removed), texts],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by one blank."""
    data = words.data.copy()
    steps = np.zeros(len(data) + 1, np.int8)
    ends = words.ends[keep]
    np.add.at(steps, words.starts[keep], 1)
    np.add.at(steps, ends, -1)
    taken = np.cumsum(steps[:-1]) > 0
    row_end = words.where[1:][words.rows()[keep]]
    blanks = ends[ends < row_end]
    data[blanks] = 0x20
    taken[blanks] = True
    size = np.append(0, np.cumsum(taken))[words.where]
    raw = data[taken].tobytes()
    return pa.array([raw[b:e].removesuffix(b" ").decode() for b, e in zip(size[:-1], size[1:], strict=True)], pa.string())


def shared_names(rows: DataFrame) -> DataFrame:
    """(name, doc, salt, earlier, later) of names that other documents have too: whether a smaller and a larger one has."""
    inner = F.col("tag") % 2 != 0
    every = Window.partitionBy("name", "tag")
    found = rows.withColumns({"first": F.min("doc").over(every), "last": F.max("doc").over(every)})
    return found.where(inner | (F.col("first") < F.col("last"))).select(
        "name",
        "doc",
        F.when(inner, F.shiftright(F.col("tag").bitwiseAND((1 << 32) - 1), 1)).otherwise(F.col("salt")).alias("salt"),
        (inner | (F.col("first") < F.col("doc"))).alias("earlier"),
        (inner | (F.col("last") > F.col("doc"))).alias("later"),
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller id.
    """
    on_workers(docs.sparkSession)
    raw = docs.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.col(text).alias("text"),
    )
    rows = raw.withColumn("digest", F.md5(F.col("text").cast("binary")))
    # tells the texts of an id apart, so that what is gathered by id stays small where an id repeats
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("digest"), F.lit(SALTS)), F.lit(0)).cast("long"))
    owner = ["doc", "salt"]
    digests = rows.select("digest", *owner)
    equal = digests.groupBy("digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    # written, so that both sides of the join are plain shuffles, of which Spark splits large partitions
    equal = written(equal.drop("most"), "equal")
    copies = (
        digests.join(equal, "digest")
        .where("doc > least")
        .groupBy(*owner)
        .agg(F.collect_set("digest").alias("copies"))
    )
    texts = rows.join(copies, owner, "left")
    marks = (
        shared_names(texts.mapInArrow(symbol_rows(window), NAMED))
        .groupBy(*owner)
        .agg(
            F.collect_list(F.when(F.col("earlier"), F.col("name"))).alias("earlier"),
            F.collect_list(F.when(F.col("later"), F.col("name"))).alias("later"),
        )
    )
    marked = texts.join(marks, owner, "left")
    repeats = (
        shared_names(marked.mapInArrow(window_rows(window), NAMED))
        .where("earlier")
        .groupBy(*owner)
        .agg(F.collect_list("name").alias("repeats"))
    )
    return marked.join(repeats, owner, "left").mapInArrow(
        cleaned_rows(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
