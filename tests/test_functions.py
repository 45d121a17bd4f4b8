from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gapweave as gw
from gapweave.functions.scalar import cell_is_valid, trim_cell
from gapweave.functions.sql import register
from gapweave.functions.time import epoch_micros, from_micros

EPOCH = datetime(1970, 1, 1)
TIMES = [
    "2015-03-08 02:30:00.123456",  # inside the New York DST gap
    "2015-11-01 01:30:00",
    "1969-12-31 23:59:59.5",
    "1850-01-01 00:00:00.000001",
    "9999-12-31 23:59:59.999999",
]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("c")).first()["c"]


@pytest.mark.parametrize("text", TIMES)
def test_epoch_micros_ignores_the_session_zone(one, text):
    t = datetime.fromisoformat(text)
    delta = t - EPOCH
    exact = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    assert value(one, epoch_micros(ntz(text))) == exact
    assert value(one, from_micros(F.lit(exact))) == t


def test_seconds_keep_the_fraction(one):
    assert value(one, gw.datediff_seconds(ntz("2015-03-08 01:59:59.5"), ntz("2015-03-08 03:00:00"))) == 3600.5
    assert value(one, gw.timestamp_to_seconds(ntz("1969-12-31 23:59:59.25"))) == -0.75


def test_linear_interpolate(one):
    args = [F.lit(v) for v in (1, 0, 10, 2, 20)]
    assert value(one, gw.linear_interpolate(*args)) == 15.0
    assert value(one, gw.linear_interpolate(F.lit(None), *args[1:])) is None
    same = [F.lit(v) for v in (1, 2, 10, 2, 20)]
    assert value(one, gw.linear_interpolate(*same, on_degenerate="null")) is None
    with pytest.raises(PySparkException):
        value(one, gw.linear_interpolate(*same))
    unknown = [F.lit(1), F.lit(2), F.lit(None).cast("double"), F.lit(2), F.lit(20)]
    assert value(one, gw.linear_interpolate(*unknown)) is None
    at = [ntz(f"2015-03-08 0{h}:00:00") for h in (2, 1, 3)]
    assert value(one, gw.linear_interpolate_ts(at[0], at[1], F.lit(1.0), at[2], F.lit(2.0))) == 1.5


def test_to_utc(one):
    instant = gw.to_utc(ntz("2015-03-08 02:30:00"), -5)
    assert value(one, F.unix_seconds(instant)) == 1425799800
    half = gw.to_utc(ntz("2015-03-23 01:00:00"), F.lit(5.5))
    assert value(one, F.unix_seconds(half)) == 1427052600
    from_parts = gw.to_utc(gw.at_time(F.lit("2015-03-23").cast("date"), F.lit(3600)), -5)
    assert value(one, F.unix_seconds(from_parts)) == 1427090400


def test_is_blank(spark):
    texts = [(None,), ("",), (" ",), ("\t\n",), ("\x01",), ("a",), (" a ",), (" ",)]
    rows = spark.createDataFrame(texts, "t string").select(gw.is_blank("t")).collect()
    assert [r[0] for r in rows] == [True, True, True, True, True, False, False, False]
    assert spark.range(1).select(trim_cell(F.lit("\t x y\n"))).first()[0] == "x y"


def test_parse_missing_and_validity(spark):
    cells = ["M", " M ", "1.5", " 7 ", "25s", "", None, "-3e2"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    rows = df.select(gw.parse_missing("c", "float", ("M",)), cell_is_valid("c", "float", ("M",))).collect()
    assert [r[0] for r in rows] == [None, None, 1.5, 7.0, None, None, None, -300.0]
    assert [r[1] for r in rows] == [True, True, True, True, False, False, False, True]
    whole = spark.createDataFrame([("-5.0",), ("12",)], "c string").select(gw.parse_missing("c", "int"))
    assert [r[0] for r in whole.collect()] == [None, 12]


def test_parse_datetime(spark):
    cells = [
        ("20150308", "0230", datetime(2015, 3, 8, 2, 30)),
        (" 20150323 ", "0053", datetime(2015, 3, 23, 0, 53)),
        ("20150231", "0000", None),
        ("20150323", "2400", None),
        ("20150323", "0060", None),
        ("20151301", "0000", None),
        ("2015032", "0000", None),
        (None, "0000", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cells], "d string, t string")
    assert [r[0] for r in df.select(gw.parse_datetime("d", "t")).collect()] == [c[2] for c in cells]
    clamped = [r[0] for r in df.select(gw.parse_datetime("d", "t", "clamp")).collect()]
    assert clamped[2] == datetime(2015, 2, 28) and clamped[3:] == [c[2] for c in cells[3:]]


def test_sql_functions(spark, readings):
    readings([("s", "2015-03-08 00:30", 10), ("s", "2015-03-08 03:30", 40)]).createOrReplaceTempView("obs")
    names = register(spark, "obs")
    assert "interpolate_temperature" in names
    row = spark.sql(
        "SELECT datediff_seconds(TIMESTAMP_NTZ'2015-03-08 02:00:00', TIMESTAMP_NTZ'2015-03-08 02:30:00.5'),"
        " timestamp_to_seconds(TIMESTAMP_NTZ'1970-01-02'), linear_interpolate(1, 0, 10, 2, 20),"
        " linear_interpolate_ts(TIMESTAMP_NTZ'2015-03-08 02:00:00', TIMESTAMP_NTZ'2015-03-08 01:00:00', 1,"
        " TIMESTAMP_NTZ'2015-03-08 03:00:00', 2)"
    ).first()
    assert tuple(row) == (1800.5, 86400.0, 15.0, 1.5)
    table = "interpolate_temperature('s', TIMESTAMP_NTZ'2015-03-08', TIMESTAMP_NTZ'{}', INTERVAL '1' HOUR)"
    rows = spark.sql(f"SELECT * FROM {table.format('2015-03-08 04:00:00')} ORDER BY r_slice").collect()
    assert [r["avg_temp"] for r in rows] == [10.0, 15.0, 25.0, 40.0, None]
    assert spark.sql(f"SELECT * FROM {table.format('2015-03-07')}").count() == 0
    with pytest.raises(PySparkException):
        spark.sql("SELECT linear_interpolate(1, 2, 10, 2, 20)").collect()
