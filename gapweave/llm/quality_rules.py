"""Quality rules: statistics of a text as Spark expressions, and a learned decision list.

The list is learned by sequential covering. A rule is a conjunction of thresholds on statistics;
it is grown on two thirds of the labelled rows, one condition at a time, by information gain, and
pruned on the other third, from its last condition backwards; rows that it covers are taken away,
and the next rule is learned on the rest, as long as rules are precise enough. The result is an
ordered list of ``when`` conditions, so the whole operator runs as DataFrame expressions.

Learning takes at most ``max_labelled`` labelled rows, those with the smallest hash of their id;
everything else covers all rows. Where an id repeats, the row that passes the base rules with the smallest hash of the text
teaches. Nothing is shuffled to score a table.

Defined cases: a null or empty text has no words and fails the base rules; labels without an id
or a class, or whose document is missing, teach nothing; an id with several labels counts with the worst; without
labels of both classes the list is empty and keeps all; a row is judged by its own text, whatever
its id and further columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5

MAX_LABELLED = 10_000
CUTS = 12
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 3

#: statistic, from the base counts
RATIOS: dict[str, str] = {
    "symbols_per_word": "n_symbols / n_words",
    "chars_per_word": "word_chars / n_words",
    "dup_line_share": "n_dup_lines / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "words": "n_words",
}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not at each place where the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(plain, " ", -1), "")


def repeated_words(words: Column) -> Column:
    """Words covered by windows of GRAM words that are found twice or more in the list."""

    def grams(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - GRAM)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(GRAM)]))

    def doubles(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: F.coalesce(x["g"] == F.get(ordered, i - 1)["g"], F.lit(False))
            | F.coalesce(x["g"] == F.get(ordered, i + 1)["g"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def covered(places: Column) -> Column:
        gains = F.transform(
            places, lambda p, i: F.least(F.lit(GRAM), F.coalesce(F.get(places, i + 1) - p, F.lit(GRAM)))
        )
        return F.aggregate(gains, F.lit(0), lambda a, b: a + b)

    def repeats(g: Column) -> Column:
        # only a text that has equal windows at all is put in order
        placed = F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("p")))
        found = bound(F.sort_array(placed), lambda o: bound(doubles(o), covered))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(found)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = bound(hashes, lambda h: bound(grams(h), repeats))
    return F.when(F.size(words) >= GRAM, found).otherwise(0)


def statistics(text: Column) -> Column:
    """The base statistics as one struct."""
    whole = F.coalesce(text, F.lit(""))

    def lines(those: Column) -> Column:
        return F.size(those) - F.size(F.array_distinct(those))

    with_word = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    return bound(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(whole, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bound(with_word, lines).cast("long").alias("n_dup_lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
    )


def ratios(stats: Column) -> dict[str, Column]:
    n = F.greatest(stats["n_words"], F.lit(1))
    out = {}
    for name, formula in RATIOS.items():
        top, _, bottom = formula.partition(" / ")
        out[name] = (stats[top] / n if bottom else stats[top]).cast("double")
    return out


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    cut: float

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.cut:g}"

    def expression(self, values: dict[str, Column]) -> Column:
        value = values[self.statistic]
        return value >= self.cut if self.at_least else value < self.cut


@dataclass
class DecisionList:
    """Rules in order, each rejecting what it covers; what no rule covers is kept."""

    rules: list[tuple[Condition, ...]]

    def __str__(self) -> str:
        lines = [f"reject if {' and '.join(map(str, rule))}" for rule in self.rules]
        return "\n".join([*lines, "keep"])

    def keeps(self, stats: Column) -> Column:
        values = ratios(stats)
        verdict = None
        for rule in self.rules:
            holds = reduce(lambda a, b: a & b, [c.expression(values) for c in rule])
            verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
        return F.lit(True) if verdict is None else verdict.otherwise(True)


# A labelled row is (bad, fold, bins), bins[i] the number of cuts of statistic i that are <= its value.
Row = tuple[bool, int, tuple[int, ...]]


def holds(row: Row, rule: Sequence[tuple[int, bool, int]]) -> bool:
    return all((row[2][f] > cut) == up for f, up, cut in rule)


def grow(rows: list[Row], cuts: Sequence[int]) -> list[tuple[int, bool, int]]:
    rule: list[tuple[int, bool, int]] = []
    while len(rule) < MAX_CONDITIONS:
        bad = sum(r[0] for r in rows)
        if not bad or bad == len(rows):
            break
        base, best = log2(bad / len(rows)), (0.0, None)
        for f, n in enumerate(cuts):
            counts = {b: Counter(r[2][f] for r in rows if r[0] == b) for b in (True, False)}
            for cut in range(n):
                for up in (True, False):
                    p, q = (sum(k for x, k in counts[b].items() if (x > cut) == up) for b in (True, False))
                    if p and (gain := p * (log2(p / (p + q)) - base)) > best[0] + 1e-9:
                        best = (gain, (f, up, cut))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if holds(r, rule[-1:])]
    return rule


def worth(rows: list[Row], rule: Sequence[tuple[int, bool, int]]) -> tuple[float, int]:
    """Precision and number of covered rows."""
    covered = [r[0] for r in rows if holds(r, rule)]
    return (sum(covered) / len(covered) if covered else 0.0), len(covered)


def prune(rows: list[Row], rule: list[tuple[int, bool, int]]) -> list[tuple[int, bool, int]]:
    """The shortest prefix of the rule that is as precise as any on the other rows."""
    best = max(range(1, len(rule) + 1), key=lambda n: (worth(rows, rule[:n])[0], -n))
    return rule[:best]


def cover(rows: list[Row], cuts: Sequence[int], min_precision: float) -> list[list[tuple[int, bool, int]]]:
    rules = []
    while len(rules) < MAX_RULES:
        growing, pruning = [r for r in rows if r[1]], [r for r in rows if not r[1]]
        rule = grow(growing, cuts)
        if not rule:
            break
        rule = prune(pruning, rule)
        precision, covered = worth(rows, rule)
        if precision < min_precision or covered < MIN_COVERED:
            break
        rules.append(rule)
        rows = [r for r in rows if not holds(r, rule)]
    return rules


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, max_labelled: int, key: str, text: str, label: str
) -> DataFrame:
    """(bad, fold, statistics) of the labelled documents that pass the base rules, one row an id."""
    chosen = (
        labels.select(F.col(key).alias("_key"), F.col(label).alias("_class"))
        .where(F.col("_key").isNotNull() & F.col("_class").isNotNull())
        .groupBy("_key")
        .agg(F.min("_class").alias("_class"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(max_labelled)
    )
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # max_labelled bounds what is sent to every task: a key and a class each
    # written, or the base rules would be moved below the join and score every document
    joined = written(rows.join(F.broadcast(chosen), "_key"), "labelled")
    stats = joined.select(
        (F.col("_class") == 0).alias("bad"), F.col("_key"), F.xxhash64("_text").alias("hash"), statistics(F.col("_text")).alias("s")
    )
    each = stats.where(~base_failed(F.col("s"))).select(
        "_key",
        F.struct(
            "hash",
            "bad",
            F.pmod(F.xxhash64(F.lit(7), "_key"), F.lit(3)).alias("fold"),
            *[c.alias(name) for name, c in ratios(F.col("s")).items()],
        ).alias("row"),
    )
    return each.groupBy("_key").agg(F.min("row").alias("row")).select("row.*").drop("hash")


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    min_precision: float = MIN_PRECISION,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DecisionList:
    """Learn to reject class 0 of ``label``."""
    names = list(RATIOS)
    rows = labelled_statistics(docs, labels, max_labelled, key, text, label).collect()  # max_labelled bounds it
    values = [[r[name] for name in names] for r in rows]
    cuts = []
    for f in range(len(names)):
        marks: set[float] = set()
        for bad in (True, False):
            own = sorted(v[f] for r, v in zip(rows, values, strict=True) if r["bad"] == bad)
            marks |= {own[(len(own) - 1) * i // CUTS] for i in range(CUTS + 1)} if own else set()
        ordered = sorted(marks)
        cuts.append([(a + b) / 2 for a, b in zip(ordered, ordered[1:], strict=False)])
    binned = [
        (r["bad"], r["fold"], tuple(sum(c <= x for c in cs) for x, cs in zip(v, cuts, strict=True)))
        for r, v in zip(rows, values, strict=True)
    ]
    rules = cover(binned, [len(c) for c in cuts], min_precision)
    return DecisionList(
        [tuple(Condition(names[f], up, cuts[f][cut]) for f, up, cut in rule) for rule in rules]
    )


def quality_verdicts(docs: DataFrame, rules: DecisionList, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, base statistics, base_failed and kept."""
    rows = docs.select(F.col(key).alias("doc_id"), statistics(F.col(text)).alias("s"))
    failed = base_failed(F.col("s"))
    return rows.select(
        "doc_id", "s.*", failed.alias("base_failed"), (~failed & rules.keeps(F.col("s"))).alias("kept")
    )


def keep_good(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The documents that neither the base rules nor the list reject."""
    good = bound(statistics(F.col(f"`{text}`")), lambda s: ~base_failed(s) & rules.keeps(s))
    return docs.where(good)
