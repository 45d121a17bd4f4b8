"""Secret scanning: three fixed kinds, and strings whose sliding-window entropy is high.

The fixed kinds are found by pattern, leftmost and without overlap within a kind. Beyond them, a
candidate string (a run of characters of base-64 or URL-safe base-64) is taken apart by character
class; over each run of a class a window slides whose Shannon entropy is kept up to date from
counts, as one character leaves and one enters. Windows at or above the class's threshold are
joined to spans of kind ``entropy``. The allow-list takes out candidates that are UUIDs or integrity hashes or
plain words, the words of a path before and after a candidate, and spans that hold an alphabet, a counter or
a word for a placeholder. Windows that touch a span of the fixed kinds don't count; what is beside it does.

Each text is looked at whole, in the task that reads it; nothing is shuffled. Defined cases: a null text counts as
empty; rows that repeat an id are scanned one by one; a very long text is scanned whole, in time in proportion to
its length; spans that begin at one place are ordered by kind; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import on_workers
from gapweave.llm.words import slices

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter run fails, and runs don't touch
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: class, its characters, window length, least entropy in bits
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]{24,}"), 24, 3.2),
    ("base64", re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}"), 20, 3.9),
)
#: whole candidates that are none
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"sha(1|256|384|512)-[A-Za-z0-9+/]+={0,2}"),
    re.compile(r"([A-Za-z]+[/_-]+)*[A-Za-z]+[0-9]{0,4}"),
)
#: parts of a path that are plain words, and spans that hold one of these
PATH_WORD = re.compile(r"[A-Z]?[a-z]{2,}(?:[_-][A-Z]?[a-z]+)*[0-9]{0,4}|")
PLACEHOLDER = re.compile(r"(?i)0123456789|abcdefghij|example|placeholder|xxxxxx")
X_LOG_X = [0.0] + [n * log2(n) for n in range(1, 513)]


def window_entropies(text: str, size: int) -> Iterator[float]:
    """Shannon entropy of each ``size`` consecutive characters, by incremental counts."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of n log n over the counts
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += X_LOG_X[n + 1] - X_LOG_X[n]
        if i >= size:
            old = text[i - size]
            n = counts[old]
            counts[old] = n - 1
            total += X_LOG_X[n - 1] - X_LOG_X[n]
        if i >= size - 1:
            yield log2(size) - total / size


def without_path_words(whole: str) -> tuple[int, int]:
    """Where a candidate begins and ends without the plain words that its path begins and ends with."""
    begin, end = 0, len(whole)
    while begin < end:
        cut = whole.find("/", begin, end)
        if cut < 0 or not PATH_WORD.fullmatch(whole, begin, cut):
            break
        begin = cut + 1
    while begin < end:
        cut = whole.rfind("/", begin, end)
        if cut < 0 or not PATH_WORD.fullmatch(whole, cut + 1, end):
            break
        end = cut
    return begin, end


def high_windows(text: str) -> Iterator[tuple[int, int]]:
    """Windows at or above the threshold of their class, candidate by candidate."""
    for candidate in CANDIDATE.finditer(text):
        whole = candidate[0]
        if any(rule.fullmatch(whole) for rule in ALLOWED):
            continue
        begin, end = without_path_words(whole)
        whole = whole[begin:end]
        for _, pattern, size, least in CLASSES:
            for run in pattern.finditer(whole):
                part = run[0]
                if not (any(c.isdigit() for c in part) and any(c.isalpha() for c in part)):
                    continue
                base = candidate.start() + begin + run.start()
                for i, bits in enumerate(window_entropies(part, size)):
                    if bits >= least:
                        yield base + i, base + i + size


def entropy_spans(text: str, taken: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Joined windows that touch none of the spans ``taken``, which are in order of their starts."""
    joined: list[tuple[int, int]] = []
    at, reach = 0, 0  # spans that begin before the window's end, and the furthest end of them
    for begin, end in sorted(high_windows(text)):
        while at < len(taken) and taken[at][0] < end:
            reach = max(reach, taken[at][1])
            at += 1
        if reach > begin:
            continue
        if joined and begin <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((begin, end))
    return [(b, e) for b, e in joined if not PLACEHOLDER.search(text, b, e)]


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the fixed kinds, and of all kinds, in order."""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    more = [(b, 3, e) for b, e in entropy_spans(text, [(start, end) for start, _, end in base])]
    return base, sorted(base + more)


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of spans of each fixed kind, SHA-256 of their list, and all spans."""
    on_workers(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [scan(x or "") for x in part.column("text").to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(3)]
            digests = [hashlib.sha256(as_text(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts, pa.array(digests), pa.array([as_text(x) for _, x in found])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
