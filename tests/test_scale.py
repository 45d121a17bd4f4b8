"""Plans and the spread of work: what must hold whatever the size of the data."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import gapweave as gw
from __spark_entry__ import queries
from gapweave.functions.sql import register
from gapweave.session import shared_folder

HOUR = timedelta(hours=1)
START, END = "2024-01-01", "2024-01-02"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def share_of_largest_task(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return len(sizes), max(sizes) / sum(sizes)


def test_long_dense_series_of_one_key_is_spread(spark):
    keys = spark.createDataFrame([("a",)], "wban string")
    rows = gw.dense_series(keys, "2024-01-01", "2024-01-05", timedelta(seconds=1))
    tasks, largest = share_of_largest_task(rows)
    assert rows.count() == 4 * 86_400 + 1
    assert tasks >= 3 and largest < 0.75


def test_long_filled_series_of_one_key_is_spread(spark, readings):
    rows = readings([("a", "2024-01-01", 1), ("a", "2024-01-05", 2)])
    filled = gw.interpolate_series(rows, "2024-01-01", "2024-01-05", timedelta(seconds=1))
    tasks, largest = share_of_largest_task(filled)
    assert filled.count() == 4 * 86_400 + 1
    assert tasks >= 3 and largest < 0.75


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_chosen_keys_act_before_the_aggregation(spark, readings, threshold):
    rows = readings([(k, datetime(2024, 1, 1, h), h) for k in "abcd" for h in range(24)])
    keys = spark.createDataFrame([("b",), ("x",)], "wban string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = gw.interpolate_series(rows, START, END, HOUR, keys)
        text = plan(result)
        expected = gw.interpolate_series(rows, START, END, HOUR, ["b", "x"])
        assert sorted(map(tuple, result.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the semi join lies below the partial aggregation of the readings
    first_partial = text.rindex("partial_min_by")
    assert "LeftSemi" in text[first_partial:]


def test_keys_of_the_range(spark, readings):
    rows = readings([("a", "2024-01-01 05:00", 1), ("b", "2023-01-01 05:00", 1)])
    found = gw.interpolate_series(rows, START, END, HOUR, "range").collect()
    assert {r.r_wban for r in found} == {"a"} and len(found) == 25
    with pytest.raises(ValueError, match="keys"):
        gw.interpolate_series(rows, START, END, HOUR, "all").collect()


def test_right_sides_of_station_joins_are_combined(spark, readings):
    rows = readings([("a", START, 1)] * 50 + [("b", START, 1)])
    candidates = spark.createDataFrame([("a",), ("c",)], "wban string")
    assert [r.wban for r in gw.new_stations(candidates, rows).collect()] == ["c"]
    assert "HashAggregate" in plan(gw.new_stations(candidates, rows))
    assert "HashAggregate" in plan(gw.known_stations(candidates, rows))


def test_ids_are_numbered_without_a_job(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "wban string")
    there = spark.createDataFrame([(7, "z")], "station_id int, wban string")
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    numbered = gw.assign_station_id(rows, after=there)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(seen)
    assert sorted(r.station_id for r in numbered.collect()) == [8, 9]


def test_broken_promise_of_unique_stations_fails(spark, readings):
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "wban string, name string")
    with pytest.raises(Exception, match="station given twice"):
        gw.enrich_with_station(readings([("a", START, 1)]), twice, unique=True).collect()


def test_previous_reading_rows_keep_columns_copies_and_order(spark, readings):
    rows = readings(
        [("a", "2024-01-01 01:00", 1), ("a", "2024-01-01 03:00", 2), ("a", "2024-01-01 03:00", 2)]
        + [("a", "2024-01-01 03:00", 5), ("b", "2024-01-01 02:00", None), ("b", None, 4)]
    )
    found = [(r.wban, r.datetime.hour, r.previous_datetime and r.previous_datetime.hour) for r in
             gw.previous_reading_rows(rows).collect()]
    assert sorted(found, key=str) == sorted(
        [("a", 1, None), ("a", 3, 1), ("a", 3, 3), ("a", 3, 3), ("b", 2, None)], key=str
    )
    values = sorted((r.temperature is None, r.temperature or 0) for r in gw.previous_reading_rows(rows).collect())
    assert values == [(False, 1.0), (False, 2.0), (False, 2.0), (False, 5.0), (True, 0)]


def test_sql_table_function_equals_the_operator(spark, readings):
    rows = readings(
        [("a", datetime(2024, 1, 1, h, m), None if (h + m) % 3 == 0 else h * m) for h in range(0, 20, 3) for m in (5, 20, 50)]
        + [("a", "2024-01-01 06:20", 9), ("b", "2024-01-01 06:20", 1)]
    )
    rows.createOrReplaceTempView("scale_weather")
    register(spark, "scale_weather")
    ask = "SELECT * FROM interpolate_temperature('a', TIMESTAMP_NTZ'{}', TIMESTAMP_NTZ'{}', INTERVAL '{}' MINUTE)"
    for minutes in (60, 15):
        got = spark.sql(ask.format("2024-01-01 00:00:00", "2024-01-01 23:00:00", minutes)).collect()
        want = gw.interpolate_series(rows, START, "2024-01-01 23:00:00", timedelta(minutes=minutes), ["a"]).collect()
        plain = lambda rs: sorted([str(r.r_slice), *(x if x is None else round(x, 6) for x in r[2:])] for r in rs)
        assert plain(got) == plain(want)
    with pytest.raises(Exception, match="not a multiple of step"):
        spark.sql(ask.format("2024-01-01 00:10:00", "2024-01-01 23:00:00", 60)).collect()


def test_sql_table_function_on_a_slice_of_many_instants(spark):
    """Half a day's slices, a reading a second, most without a value: all in one block, equal to the operator."""
    at = F.expr("timestampadd(MILLISECOND, CAST(id * 1300 AS INT), TIMESTAMP_NTZ'2024-01-01')")
    value = F.when(F.col("id") % 61 == 5, (F.col("id") % 13).cast("double"))
    rows = spark.range(60_000).select(F.lit("a").alias("wban"), at.alias("datetime"), value.alias("temperature"))
    rows.createOrReplaceTempView("many_instants")
    register(spark, "many_instants")
    found = spark.sql(
        "SELECT * FROM interpolate_temperature('a', TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-02', INTERVAL '12' HOUR)"
    )
    plain = lambda rs: sorted([str(r.r_slice), *(round(x, 6) for x in r[2:] if x is not None)] for r in rs)
    want = gw.interpolate_series(rows, START, END, timedelta(hours=12), ["a"]).collect()
    assert plain(found.collect()) == plain(want)
    # the windows over instants span 16 seconds of a slice; all others run over their summaries
    windows = [w for w in plan(found).split("\n") if "Window [" in w]
    over_instants = [w for w in windows if "us#" in w.split("windowspecdefinition", 1)[1]]
    assert over_instants and all("part#" in w for w in over_instants)


def test_shared_folder_is_the_one_that_is_set():
    class Set(Elsewhere):
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: "/tmp/of-the-cluster/")

    assert shared_folder(Set) == "/tmp/of-the-cluster"


class Elsewhere:
    """A session on a cluster without a shared folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_dense_slices_unfold_in_many_tasks_without_arithmetic_for_each(spark, zone):
    """A small file of keys is one partition; all series unfolded in one task."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        keys = spark.range(400).selectExpr("CAST(id AS STRING) AS wban").coalesce(1)
        for first, count, step in ((datetime(2015, 3, 7), 72, 3600), (datetime(1969, 12, 31, 20, 0, 1), 70_000, 1)):
            chosen = keys if count < 1_000 else keys.where("wban = '7'")
            end = first + timedelta(seconds=step * (count - 1) + step // 2)
            found = gw.dense_series(chosen, first, end, timedelta(seconds=step))
            assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
            assert "timestampadd(MICROSECOND, _us" not in plan(found)
            rows = sorted(r["slice"] for r in found.where("wban = '7'").collect())
            assert rows == [first + timedelta(seconds=step * i) for i in range(count)]
            sizes = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert count > 1_000 or max(r["count"] for r in sizes) <= 0.4 * 400 * count
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_seconds_are_counted_by_a_number(spark):
    """The start of the hour as a timestamp costs more than all else: it is made for each hour, not for each second."""
    lines = plan(queries()["dense_series_1s"](spark, "/root/testdata/sf0.001")).split("\n")
    keys = [x.split("functions=")[0] for x in lines if "HashAggregate(" in x]
    assert keys and not any("timestampadd" in x.lower() for x in keys)
    row = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS ts")
    for rounding, us in (("floor", -3_600_000_000), ("reference", 0)):
        assert row.select(gw.slice_micros("ts", HOUR, rounding)).first()[0] == us
