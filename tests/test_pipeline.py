from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gapweave as gw
from gapweave.plans.ingest import to_observations, to_weather_rows, with_station
from gapweave.schemas import WEATHER_DATA, create_tables
from gapweave.session import kept

HOURLY_HEADER = ",".join(f"h{i}" for i in range(44))
STATION_HEADER = (
    "WBAN|WMO|CallSign|ClimateDivisionCode|ClimateDivisionStateCode|ClimateDivisionStationCode|Name|State|"
    "Location|Latitude|Longitude|GroundHeight|StationHeight|Barometer|TimeZone"
)


def hourly(wban, date, time, sky="CLR", temperature="10.5", wind="3", pressure="29.9", cells=44):
    line = [""] * cells
    values = {0: wban, 1: date, 2: time, 4: sky, 12: temperature, 24: wind, 30: pressure}
    for i, v in values.items():
        if i < cells:
            line[i] = v
    return ",".join(line)


GOOD = [
    hourly("00102", "20150323", "0053"),
    hourly("00102", "20150323", "0153", temperature="M", wind="M", pressure="M"),
    hourly("00102", "20150308", "0230", sky='A "q" b', temperature=" 7.5 ", cells=31),
]
UNKNOWN = hourly("99999", "20150323", "0453")
BAD = [
    hourly("00102", "20150323", "0353", temperature="25s"),
    hourly("00102", "20150323", "0353", pressure=""),
    hourly("00102", "20150231", "0353"),
    hourly("00102", "20150323", "2400"),
    hourly("00102", "20150323", "0453", cells=20),
]
STATIONS = [
    "00102|w|c|1|2|3|FIRST|AK|Loc|61.5|-149.25|10||20|-9",
    "00102|w|c|1|2|3|SECOND|AK|Loc|61.5|-149.25|10||20|-9",
    "00103|w|c|1|2|3|NO LATITUDE|AK|Loc||-149.25|10||20|-9",
    "00104|w|c|1|2|3|BAD HEIGHT|AK|Loc|1|-149.25|x||20|-9",
    "00105|w|c|1|2|3|NO ZONE|AK|Loc|1|-149.25| ||20|",
    "00106|w|c|1|2|3|SHORT|AK",
    '00107|w|c|1|2|3|A "q" b| |Loc|1|2| |7|20|5|extra',
]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "hourly").mkdir()
    # Header lines are skipped in every file.
    (tmp_path / "hourly" / "a.txt").write_text("\n".join([HOURLY_HEADER, *GOOD, UNKNOWN, ""]) + "\n")
    (tmp_path / "hourly" / "b.txt").write_text("\n".join([HOURLY_HEADER, *BAD]) + "\n")
    (tmp_path / "stations.txt").write_text("\n".join([STATION_HEADER, *STATIONS]) + "\n")
    return tmp_path


EXPECTED = [
    ("00102", datetime(2015, 3, 8, 2, 30), 7.5, 3.0, 29.9, 'A "q" b'),
    ("00102", datetime(2015, 3, 23, 0, 53), 10.5, 3.0, 29.9, "CLR"),
    ("00102", datetime(2015, 3, 23, 1, 53), None, None, None, "CLR"),
]


def weather(df):
    rows = df.orderBy("wban", "datetime").select(WEATHER_DATA.names).collect()
    return [tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in rows]


def test_read_hourly(spark, files):
    valid, rejected = gw.read_hourly(spark, str(files / "hourly"))
    assert valid.count() == len(GOOD) + 1
    assert rejected.count() == len(BAD)
    clamped, _ = gw.read_hourly(spark, str(files / "hourly"), day_overflow="clamp")
    assert clamped.where("date = '2015-02-28'").count() == 1


def test_read_stations(spark, files):
    valid, rejected = gw.read_stations(spark, str(files / "stations.txt"))
    assert [r["name"] for r in valid.collect()] == ["FIRST", "SECOND", 'A "q" b']
    assert rejected.count() == 4
    first = gw.load_stations(spark, str(files / "stations.txt"))
    assert sorted(r["name"] for r in first.collect()) == ['A "q" b', "FIRST"]


def test_first_station_goes_by_file_and_line(spark, tmp_path):
    for name, stations in (("b.txt", ["LATER"]), ("a.txt", ["EARLIER", "SECOND"])):
        lines = [f"1|w|c|1|2|3|{n}|AK|Loc|1|2|3|4|5|6" for n in stations]
        (tmp_path / name).write_text("\n".join([STATION_HEADER, *lines]) + "\n")
    assert [r["name"] for r in gw.load_stations(spark, str(tmp_path)).collect()] == ["EARLIER"]


def test_ingest(spark, files):
    rows = gw.ingest(spark, str(files / "hourly"), str(files / "stations.txt"))
    assert rows.schema.fieldNames() == WEATHER_DATA.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in WEATHER_DATA]
    assert weather(rows) == EXPECTED


def test_enriched_model(spark, files):
    valid, _ = gw.read_hourly(spark, str(files / "hourly"))
    nested = with_station(to_observations(valid), gw.load_stations(spark, str(files / "stations.txt")))
    row = nested.first()
    assert row["station"]["geo_location"]["lat"] == 61.5 and row["station"]["name"] == "FIRST"
    assert weather(to_weather_rows(nested)) == EXPECTED


def test_stream_equals_batch_and_restart_adds_nothing(spark, files):
    stations = gw.load_stations(spark, str(files / "stations.txt"))
    target, checkpoint = str(files / "table"), str(files / "checkpoint")

    def run():
        query = gw.stream_ingest(
            spark, str(files / "hourly"), stations, target, checkpoint, every=None, max_files=1
        )
        query.awaitTermination()
        return weather(gw.read_weather(spark, target))

    assert run() == EXPECTED
    assert run() == EXPECTED
    (files / "hourly" / "c.txt").write_text(
        "\n".join([HOURLY_HEADER, hourly("00107", "20150324", "0000", temperature="1")]) + "\n"
    )
    assert run() == [*EXPECTED, ("00107", datetime(2015, 3, 24), 1.0, 3.0, 29.9, "CLR")]


def test_calls_with_the_default_checkpoint_lose_and_repeat_nothing(spark, files):
    stations = gw.load_stations(spark, str(files / "stations.txt"))
    target = str(files / "table")

    def run(folder, **options):
        gw.stream_ingest(spark, str(folder), stations, target, every=None, **options).awaitTermination()
        return weather(gw.read_weather(spark, target))

    assert run(files / "hourly", max_files=1) == EXPECTED
    assert run(files / "hourly", max_files=5) == EXPECTED
    other = files / "other"
    other.mkdir()
    (other / "c.txt").write_text(
        "\n".join([HOURLY_HEADER, hourly("00107", "20150324", "0000", temperature="1")]) + "\n"
    )
    more = [*EXPECTED, ("00107", datetime(2015, 3, 24), 1.0, 3.0, 29.9, "CLR")]
    assert run(other) == more
    assert run(files / "hourly") == more
    assert gw.read_weather(spark, target).columns == [
        "wban", "datetime", "temperature", "windspeed", "stationpressure", "skycondition"
    ]
    with pytest.raises(ValueError, match="doesn't know of"):
        run(files / "hourly", checkpoint=str(files / "fresh"))


def test_running_stream_with_processing_time(spark, files):
    stations = gw.load_stations(spark, str(files / "stations.txt"))
    query = gw.stream_ingest(spark, str(files / "hourly"), stations, str(files / "table"), every="1 second")
    try:
        query.processAllAvailable()
        assert weather(gw.read_weather(spark, str(files / "table"))) == EXPECTED
    finally:
        query.stop()


def test_stream_joined_with_static_stations(spark, files):
    stations = spark.createDataFrame([("00102", "FIRST")], "wban string, name string")
    from gapweave.streaming.ingest import hourly_stream

    rows = gw.enrich_with_station(hourly_stream(spark, str(files / "hourly")), stations, unique=True)
    query = (
        rows.writeStream.format("memory").queryName("enriched_rows").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = spark.table("enriched_rows").collect()
    assert len(found) == 3 and {r["name"] for r in found} == {"FIRST"}


@pytest.mark.parametrize("by_day", [False, True])
def test_write_and_read_weather(spark, files, by_day):
    path = str(files / "table")
    rows = gw.ingest(spark, str(files / "hourly"), str(files / "stations.txt"))
    gw.write_weather(rows, path, by_day=by_day, max_records_per_file=2)
    gw.write_weather(rows.limit(0), path, by_day=by_day)
    assert weather(gw.read_weather(spark, path)) == EXPECTED
    assert weather(gw.read_weather(spark, path, "2015-03-23", "2015-03-23 00:53:00")) == EXPECTED[1:2]


def test_tables(spark, files, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sample LOCATION '{tmp_path}/warehouse'")
    create_tables(spark)
    create_tables(spark)
    assert spark.table("sample.station").schema.fieldNames()[:3] == ["station_id", "wban", "name"]
    gw.append_weather_table(
        gw.ingest(spark, str(files / "hourly"), str(files / "stations.txt")), "sample.weather_data"
    )
    assert weather(spark.table("sample.weather_data")) == EXPECTED
    spark.sql("DROP DATABASE sample CASCADE")


def test_upsert(spark, files):
    valid, _ = gw.read_stations(spark, str(files / "stations.txt"))
    candidates = gw.to_station_rows(valid).withColumn("position", F.monotonically_increasing_id())
    existing = gw.assign_station_id(gw.to_station_rows(valid.where("wban = '00107'")), after=6)
    assert [r["station_id"] for r in existing.collect()] == [7]
    added = gw.upsert_stations(candidates, existing, "position").collect()
    assert [(r["station_id"], r["wban"], r["name"]) for r in added] == [(8, "00102", "FIRST")]
    both = gw.upsert_stations(candidates, existing.where("false"), "position").collect()
    assert sorted(r["station_id"] for r in both) == [1, 2]
    blank = gw.to_station_rows(valid).where("wban = '00107'").first()
    assert blank["state"] is None


def test_station_ids_are_gap_free(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("wban")).repartition(7)
    ids = gw.assign_station_id(rows, after=10)
    assert sorted(r[0] for r in ids.select("station_id").collect()) == list(range(11, 511))
    assert sorted(map(str, ids.collect())) == sorted(
        map(str, gw.assign_station_id(rows.repartition(2), after=10).collect())
    )


def test_smallint_overflow_is_an_error(spark, files):
    valid, _ = gw.read_stations(spark, str(files / "stations.txt"))
    with pytest.raises(PySparkException):
        gw.to_station_rows(valid.withColumn("ground_height", F.lit(40_000))).collect()


def test_constraints(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "wban string, n int")
    assert [tuple(r) for r in gw.check_unique(df, "wban").collect()] == [("a", 2)]
    assert sorted(map(tuple, gw.check_not_null(df, "wban", "n").collect())) == [("n", 2), ("wban", 1)]
    assert gw.check_not_null(df.where("n = 1"), "n").count() == 0


def test_dedupe_and_joins(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "first"), ("b", 5, "only"), (None, 0, "none")], "wban string, n int, v string"
    )
    assert sorted(r["v"] for r in gw.dedupe_first(df, "wban", "n").collect()) == ["first", "only"]
    known = spark.createDataFrame([("a",), ("a",)], "wban string")
    assert gw.known_stations(df, known).count() == 2
    assert sorted(r["v"] for r in gw.new_stations(df, known).collect()) == ["none", "only"]
    doubled = known.withColumn("name", F.lit("x"))
    assert gw.enrich_with_station(df, doubled).count() == 2


def test_a_kept_table_has_a_known_size(spark):
    """A stream joins it in each micro-batch: Spark has to know that it is small before it shuffles anything."""
    names = kept(spark.range(1000).selectExpr("CAST(id AS STRING) AS wban").groupBy("wban").count(), "names")
    joined = spark.range(10_000_000).selectExpr("CAST(id AS STRING) AS wban").join(names, "wban")
    assert joined.count() == 1000
    assert "SortMergeJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
