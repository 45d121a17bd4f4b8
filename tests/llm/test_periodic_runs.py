"""Periodic runs against a scan of every period of every text."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapweave.llm import periodic_runs as op
from gapweave.llm.run_queries import op13_periodic_runs, with_planted

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def row(doc_id, text):
    words = planted(doc_id, words_of(text))
    found = runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    lines = "".join("{},{},{}\n".format(*r) for r in found)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
    )


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def made(pick):
    """Words with runs in runs: repeated parts of what is there, of few or many words."""
    words = []
    for _ in range(pick.randint(0, 6)):
        base = [pick.randint(0, pick.choice([1, 2, 40])) for _ in range(pick.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 40]))]
        if words and pick.random() < 0.4:
            at = pick.randrange(len(words))
            base = words[at : at + pick.randint(1, 60)]
        words += (base * pick.randint(1, 6))[: pick.randint(1, 200)]
    return words


def test_runs_equal_scan():
    pick = random.Random(3)
    rows, total = [], 0
    for _ in range(400):
        rows = [made(pick) for _ in range(pick.randint(1, 4))]
        flat = np.array([w for r in rows for w in r], np.int64)
        begin = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)
        want = sorted((int(begin[i]) + s, length, q) for i, r in enumerate(rows) for s, length, q in runs(r))
        assert sorted(zip(*[x.tolist() for x in op.runs_of(flat, begin)], strict=True)) == want
        total += len(want)
    assert total > 400


def test_stretch_of_a_small_period_at_both_ends():
    """Blocks inside a small period give many occurrences; the large period comes from where these begin and end."""
    unit = ["a"] * 50 + ["b"] * 50
    for words in (unit * 3, ["x"] + unit * 4 + ["a"] * 20, fibonacci(900), ["a"] * 500, list("abaab" * 40)):
        numbers = np.unique(words, return_inverse=True)[1].astype(np.int64)
        found = op.runs_of(numbers, np.array([0, len(numbers)]))
        assert list(zip(*[x.tolist() for x in found], strict=True)) == runs(words)


def test_wavelet_successor():
    pick = np.random.default_rng(1)
    values = pick.permutation(777)
    matrix = op.WaveletMatrix(values)
    left = pick.integers(0, 777, 300)
    right = np.minimum(777, left + pick.integers(0, 200, 300))
    bound = pick.integers(0, 900, 300)
    nth = matrix.count_below(left, right, bound)
    found = matrix.smallest(left, right, nth)
    for lo, hi, b, x in zip(left, right, bound, found, strict=True):
        assert x == min((v for v in values[lo:hi] if v >= b), default=777)


ROWS = [
    (None, "a b c " * 20), (0, None), (1, ""), (2, " \t\n"), (3, "w " * 23), (4, "w " * 24), (5, "w  \n" * 500),
    (6, "a b c " * 8 + "end"), (6, "a b c " * 8 + "end"), (7, "Ä ä " * 13), (8, "x" * 100_000 + " y" * 30),
    (9, " ".join(fibonacci(3000))), (10, "p q r s " * 4000), (11, "one two three"), (12, "k l m n o p q r s " * 3),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({n: F.lit(n) for n in ("runs", "n_words", "collapsed", "words")})
    found = {}
    for r in op.periodic_runs(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    for doc_id, text in ROWS:
        words = words_of(text)
        want = runs(words) if len(words) < 5000 else [(0, len(words), 4)]
        for answer in found[doc_id]:
            assert answer == (len(words), want, collapsed(words, want))
    assert sum(map(len, found.values())) == len(ROWS)
    assert op.periodic_runs(docs.limit(0)).count() == 0


def test_planting(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0] + [1, 2]
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37))) for i in ids] + [(ids[0], None), (None, "a b")]
    found = with_planted(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr((r[0], words_of(r[1]))) for r in found) == sorted(repr((i, planted(i, words_of(t)))) for i, t in rows)


def test_query_equals_scan(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = op13_periodic_runs(spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == sorted(row(*r) for r in source)
    assert sum(r["n_runs"] for r in found) > 20


@pytest.mark.parametrize("size", [1, 5, 64, 1000])
def test_chunks_hold_all_rows(size, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_WORDS", size)
    rows = np.array([0, 2, 3, 7, 8])
    counts = np.arange(10) * 3
    assert np.concatenate(list(op.chunks(rows, counts))).tolist() == rows.tolist()
