"""The clustered layout: few files for a station or a span of time, and all of their rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import gapweave as gw
from gapweave.sources.layout import bounds_table, read_weather_clustered, write_weather_clustered, z_order

BEGIN = datetime(2024, 1, 1)
FILES = 64


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """300 stations, one of which has a third of all rows."""
    path = str(tmp_path_factory.mktemp("layout") / "with blank")
    ids = spark.range(60_000)
    at = F.expr("timestampadd(SECOND, CAST(id * 43 AS INT), TIMESTAMP_NTZ'2024-01-01')")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 300))
    rows = ids.select(
        key.alias("wban"), at.alias("datetime"), F.col("id").cast("float").alias("temperature"),
        F.lit(None).cast("float").alias("windspeed"), F.lit(1.0).alias("stationpressure"), F.lit("CLR").alias("skycondition"),
    )
    odd = rows.where("temperature < 2").withColumn("wban", F.lit(None).cast("string"))
    odd = odd.unionByName(rows.where("temperature < 2").withColumn("datetime", F.lit(None).cast("timestamp_ntz")))
    write_weather_clustered(rows.unionByName(odd), path, FILES)
    return path, rows


def opened(df):
    return len(df.inputFiles())


def same(found, want):
    columns = ["wban", "datetime", "temperature"]
    return sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_one_station_opens_few_files(spark, table):
    path, rows = table
    assert bounds_table(spark, path).read().agg(F.sum("rows")).first()[0] == 60_004
    for keys in (["s7"], ["s7", "s11", "nobody"]):
        found = read_weather_clustered(spark, path, keys)
        assert same(found, rows.where(F.col("wban").isin(keys)))
        assert opened(found) <= len(keys) * FILES // 5
    assert read_weather_clustered(spark, path, []).count() == 0


def test_one_span_opens_few_files(spark, table):
    path, rows = table
    day = read_weather_clustered(spark, path, None, "2024-01-10", "2024-01-10 23:59:59")
    assert same(day, rows.where("date(datetime) = '2024-01-10'"))
    assert opened(day) <= FILES // 3
    hot = read_weather_clustered(spark, path, ["hot"], "2024-01-10", "2024-01-10 23:59:59")
    assert same(hot, rows.where("date(datetime) = '2024-01-10' AND wban = 'hot'"))
    assert opened(hot) <= FILES // 8


def test_a_hot_station_spreads_over_files(spark, table):
    path, _ = table
    largest = bounds_table(spark, path).read().agg(F.max("rows")).first()[0]
    assert largest < 3 * 60_000 / FILES


def test_pushdown_and_all_rows(spark, table):
    path, rows = table
    text = read_weather_clustered(spark, path, ["s7"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(wban,s7)" in text or "In(wban, [s7])" in text
    assert read_weather_clustered(spark, path).count() == 60_004


def test_further_batches_and_interpolation(spark, table, tmp_path):
    path = str(tmp_path)
    _, rows = table
    halves = [rows.where("temperature < 30000"), rows.where("temperature >= 30000")]
    for half in halves:
        write_weather_clustered(half, path, 8, between=(BEGIN, BEGIN + timedelta(days=30)))
    write_weather_clustered(rows.limit(0), path, 2)
    ask = (BEGIN, BEGIN + timedelta(days=29), timedelta(hours=6))
    found = gw.interpolate_series(read_weather_clustered(spark, path, ["s7"]), *ask, ["s7"])
    assert sorted(map(str, found.collect())) == sorted(map(str, gw.interpolate_series(rows, *ask, ["s7"]).collect()))


def test_z_order(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (3, 5), (65535, 0), (0, 65535), (65535, 65535), (40000, 12345)]
    df = spark.createDataFrame(pairs, "a long, b long").select(z_order(F.col("a"), F.col("b")))
    want = [sum(((a >> i & 1) << 2 * i + 1) | ((b >> i & 1) << 2 * i) for i in range(16)) for a, b in pairs]
    assert [r[0] for r in df.collect()] == want


def test_quantile_sketch_ranks(spark):
    """Of 200,000 values of a slice; up to k values it is exact."""
    at = F.expr("TIMESTAMP_NTZ'2024-01-01 05:00:00'")
    rows = spark.range(200_000).select(
        F.lit("a").alias("wban"), at.alias("datetime"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("temperature")
    )
    few = spark.range(9).select(F.lit("b").alias("wban"), at.alias("datetime"), F.col("id").cast("double").alias("temperature"))
    asked = (0.0, 0.1, 0.5, 0.99, 1.0)
    aggs = {f"q{i}": gw.quantile(q) for i, q in enumerate(asked)}
    found = {r["wban"]: r for r in gw.resample(rows.unionByName(few), timedelta(hours=1), aggs).collect()}
    assert [found["b"][f"q{i}"] for i in (0, 2, 4)] == [0.0, 4.0, 8.0]
    for i, q in enumerate(asked):
        rank = rows.where(F.col("temperature") <= found["a"][f"q{i}"]).count() / 200_000
        assert abs(rank - q) < 0.03
    with pytest.raises(ValueError, match="between"):
        gw.quantile(1.5)
