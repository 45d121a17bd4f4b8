"""How many records the operators shuffle, and what their plans share."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import gapweave as gw
from gapweave.operators import fill

HOUR = timedelta(hours=1)
START, END = "2024-01-01", "2024-01-01 23:00:00"
PER_SLICE, STATIONS = 200, 5
READINGS, STATES = 24 * PER_SLICE * STATIONS, 24 * STATIONS


def exchanges(df):
    """(records written, description) of every shuffle of a DataFrame that has been run, once each."""
    found = {}

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind == "ReusedExchangeExec":
            return None
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ShuffleExchangeExec":
            found[node.id()] = (int(node.metrics().apply("shuffleRecordsWritten").value()), node.toString()[:300])
        for part in (node.children(), node.subqueries()):
            for i in range(part.size()):
                walk(part.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return list(found.values())


def run(df):
    """The rows, and the records that were shuffled to get them."""
    rows = df.collect()
    return rows, sum(n for n, _ in exchanges(df))


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def dense_readings(spark, tmp_path):
    """A stored table of readings every 18 seconds, of which those that ``missing`` names have no value."""

    def build(missing):
        made(spark, missing).write.parquet(str(tmp_path / "readings"))
        return spark.read.parquet(str(tmp_path / "readings"))

    return build


def made(spark, missing):
    place = F.col("id") % (24 * PER_SLICE)
    at = F.expr("timestampadd(SECOND, CAST(id % 4800 * 18 AS INT), TIMESTAMP_NTZ'2024-01-01')")
    rows = spark.range(READINGS).select(
        F.concat(F.lit("s"), F.col("id") % STATIONS).alias("wban"), at.alias("datetime"),
        F.when(~missing(place), (F.col("id") % 97).cast("double")).alias("temperature"),
    )
    return rows.repartition(4, "datetime")


def test_readings_without_a_value_in_few_slices_shuffle_few_readings(spark, no_broadcast, dense_readings):
    rows = dense_readings(lambda place: place % 1200 == 77)
    result = gw.interpolate_series(rows, START, END, HOUR, keys=[f"s{i}" for i in range(STATIONS)])
    found, shuffled = run(result)
    assert len(found) == STATES and all(r["avg_temp"] is not None for r in found)
    entangled = 4 * STATIONS * PER_SLICE  # slices with a reading without a value, readings of theirs
    words = 4 * fill.FILTER_WORDS  # the filter, a constant
    assert shuffled - words < 3 * entangled + 40 * STATES < READINGS


def test_without_entangled_slices_no_reading_is_shuffled(spark, no_broadcast, dense_readings, monkeypatch):
    monkeypatch.setattr(fill, "FILTER_WORDS", 64)
    monkeypatch.setattr(fill, "SLICE_BIT", "pmod(xxhash64(_key, slice_us), 4096L)")
    rows = dense_readings(lambda place: place % 200 >= 150)  # the last quarter of every hour
    for method in ("linear", "forward"):
        result = gw.interpolate_series(rows, START, END, HOUR, method=method)
        found, shuffled = run(result)
        assert len(found) == STATES
        assert shuffled < 30 * STATES


def test_states_are_aggregated_once(spark, dense_readings):
    rows = dense_readings(lambda place: place % 7 == 3)
    result = gw.interpolate_series(rows, START, END, HOUR, keys=["s1"])
    result.collect()
    wide = [text for _, text in exchanges(result) if "hashpartitioning(_key" in text and "slice_us" in text]
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text
    assert wide


@pytest.mark.parametrize("words", [1, 8, 1 << 16])
def test_any_size_of_the_filter_gives_the_same_answer(spark, readings, monkeypatch, words):
    """A filter of 64 bits lets nearly all slices through; they change nothing."""
    monkeypatch.setattr(fill, "FILTER_WORDS", words)
    monkeypatch.setattr(fill, "SLICE_BIT", f"pmod(xxhash64(_key, slice_us), {words * 64}L)")
    rows = readings(
        [(k, datetime(2024, 1, 1, h, m), None if (h * 7 + m + ord(k)) % 4 else h + m) for k in "abc" for h in range(24) for m in range(0, 60, 7)]
    )
    found = gw.interpolate_series(rows, START, END, HOUR).collect()
    filled = gw.interpolate(rows, START, END, HOUR).collect()
    key = lambda r: tuple(map(str, r))
    if not hasattr(test_any_size_of_the_filter_gives_the_same_answer, "seen"):
        test_any_size_of_the_filter_gives_the_same_answer.seen = (sorted(map(key, found)), sorted(map(key, filled)))
    assert test_any_size_of_the_filter_gives_the_same_answer.seen == (sorted(map(key, found)), sorted(map(key, filled)))


def test_gap_detection_shuffles_two_rows_a_bucket(spark, no_broadcast, dense_readings):
    rows = dense_readings(lambda place: F.lit(False))
    found, shuffled = run(gw.find_gaps(rows, 3600))
    assert found == []
    assert shuffled < 30 * STATES
