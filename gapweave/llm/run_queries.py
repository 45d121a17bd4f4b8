"""The query of the periodic runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.periodic_runs import periodic_runs


def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth id, by its CRC-32 h, repeats words of its own from word a on.

    With n words and g = h // 10: a = g mod n, and the period is 1 + (n - a) // (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumns({"g": F.expr("h div 10"), "a": F.expr("IF(n > 0, h div 10 % n, 0L)")})
    rows = rows.withColumn("p", F.expr("1L + (n - a) div (3L + g % 8L)"))
    tail = "flatten(array_repeat(slice(words, CAST(a + 1 AS INT), CAST(p AS INT)), CAST((n - a) div p + 1 AS INT)))"
    planted = f"array_join(slice(concat(slice(words, 1, CAST(a AS INT)), {tail}), 1, CAST(n AS INT)), ' ')"
    return rows.select("doc_id", F.expr(f"IF(n > 0, {planted}, text)").alias("text"))


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


def line(run: Column) -> Column:
    return F.concat_ws(",", *[run[c].cast("string") for c in ("start", "length", "period")])


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted(spark.read.parquet(f"{folder}/documents.parquet")))
    best = found.withColumn("best", most_repeated(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
