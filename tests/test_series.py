import random
from datetime import datetime, timedelta

import pytest
from brute import aligned, filled, gaps, summary
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gapweave as gw

HOUR = timedelta(hours=1)
RANGE = ("2015-03-23", "2015-03-23 04:00:00", HOUR)
A = [("s", "2015-03-23 00:30", 10), ("s", "2015-03-23 03:30", 40)]
B = [
    ("s", "2015-03-22 23:30", 5),
    ("s", "2015-03-23 01:10", 10),
    ("s", "2015-03-23 01:50", 20),
    ("s", "2015-03-23 03:30", 40),
    ("s", "2015-03-23 05:10", 0),
]
M = [*A, ("s", "2015-03-23 02:10", None)]


def temps(df):
    return [tuple(r)[2:] for r in df.orderBy("r_slice").collect()]


def same(*values):
    return [(v, v, v) for v in values]


# -- fixtures worked out by hand ---------------------------------------------------


@pytest.mark.parametrize("block_slices", [1, 2, 65_536])
def test_fixture_values(readings, block_slices):
    def run(rows, **options):
        return temps(gw.interpolate_series(readings(rows), *RANGE, block_slices=block_slices, **options))

    assert run(A) == same(10, 15, 25, 40, None)
    assert run(B) == [*same(None), (10, 20, 15), *same(22, 40, None)]
    assert run(M) == same(10, 15, 25, 40, None)
    assert run(M, anchors="independent", on_degenerate="null") == same(10, 19, None, 40, None)


def test_independent_anchors_divide_by_zero(readings):
    with pytest.raises(PySparkException):
        gw.interpolate_series(readings(M), *RANGE, anchors="independent").collect()


def test_unaligned_start(readings):
    bounds = ("2015-03-23 00:15:00", "2015-03-23 04:15:00", HOUR)
    with pytest.raises(ValueError):
        gw.interpolate_series(readings(A), *bounds)
    rows = gw.interpolate_series(readings(A), *bounds, strict_alignment=False).orderBy("r_slice").collect()
    assert [r["r_slice"].minute for r in rows] == [15] * 5
    assert [tuple(r)[2:] for r in rows] == same(*[None] * 5)


def test_reversed_range_is_empty(readings):
    bounds = ("2015-03-23 04:00:00", "2015-03-23", HOUR)
    assert gw.interpolate_series(readings(M), *bounds).count() == 0
    assert gw.align_to_series(readings(M), *bounds).count() == 0
    assert gw.fill_forward(readings(M), *bounds).count() == 0


def test_one_instant_with_and_without_value(readings):
    rows = [*A, ("s", "2015-03-23 03:30", None), ("s", "2015-03-23 03:20", None), ("s", "2015-03-23 03:40", None)]
    with pytest.raises(PySparkException):
        gw.interpolate_series(readings(rows), *RANGE).collect()
    # 03:20 is before the first known reading of its slice: (03:00 - 00:30) / 3 h of the way up.
    last = temps(gw.interpolate_series(readings(rows), *RANGE, on_degenerate="null"))[3]
    assert last == (35, 40, 37.5)


def test_result_columns_and_order(readings):
    df = gw.interpolate_series(readings([*A, ("r", "2015-03-23 01:00", 1)]), *RANGE, ordered=True)
    assert df.dtypes == [
        ("r_wban", "string"),
        ("r_slice", "timestamp_ntz"),
        ("min_temp", "double"),
        ("max_temp", "double"),
        ("avg_temp", "double"),
    ]
    rows = [tuple(r)[:2] for r in df.collect()]
    assert rows == sorted(rows) and len(rows) == 10


def test_keys(spark, readings):
    data = readings([*A, ("other", "2015-03-23 01:00", 1), (None, "2015-03-23 01:00", 1)])
    for keys in (["s", "absent", "s"], spark.createDataFrame([("s",), ("absent",), ("s",)], "k string")):
        rows = gw.interpolate_series(data, *RANGE, keys).collect()
        assert len(rows) == 10
        assert {r["r_wban"] for r in rows if r["avg_temp"] is not None} == {"s"}
    assert gw.interpolate_series(data, *RANGE).count() == 10
    assert gw.align_to_series(data, *RANGE, keys=["absent"]).count() == 5


def test_slices(spark):
    times = ["2015-03-23 01:59:59.7", "1969-12-31 23:50:00", "2015-03-08 02:30:00", "2015-03-23 02:29:59.5"]
    df = spark.createDataFrame([(datetime.fromisoformat(t),) for t in times], "t timestamp_ntz")
    reference = [r[0] for r in df.select(gw.time_slice("t", HOUR)).collect()]
    floor = [r[0] for r in df.select(gw.time_slice("t", HOUR, "floor")).collect()]
    assert reference[:3] == [datetime(2015, 3, 23, 2), datetime(1970, 1, 1), datetime(2015, 3, 8, 2)]
    assert floor[:3] == [datetime(2015, 3, 23, 1), datetime(1969, 12, 31, 23), datetime(2015, 3, 8, 2)]
    for bad in (timedelta(0), timedelta(seconds=-1), timedelta(milliseconds=1500)):
        with pytest.raises(ValueError):
            gw.time_slice("t", bad)
    with pytest.raises(TypeError):
        gw.time_slice("t", "1 month")


def test_dense_series(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "wban string")
    week = gw.dense_series(keys, "2015-03-23", "2015-03-30", HOUR)
    assert week.count() == 2 * 169
    dst = gw.dense_series(keys.limit(1), "2015-03-08", "2015-03-09", HOUR).orderBy("slice").collect()
    assert [r["slice"] for r in dst] == [datetime(2015, 3, 8) + i * HOUR for i in range(25)]
    assert gw.dense_series(keys, "2015-03-09", "2015-03-08", HOUR).count() == 0
    long = gw.dense_series(keys, "2015-03-23", "2015-03-26", timedelta(seconds=1))
    assert long.count() == long.distinct().count() == 2 * 259_201


def test_zoned_timestamps_are_refused(spark):
    df = spark.range(1).select(F.lit("s").alias("wban"), F.current_timestamp().alias("datetime"))
    with pytest.raises(TypeError):
        gw.find_gaps(df)


# -- gaps --------------------------------------------------------------------------


def test_gap_threshold_is_strict(readings):
    data = readings(
        [
            ("a", "2015-03-23 00:00:00", 1),
            ("a", "2015-03-23 01:00:00", 1),
            ("b", "2015-03-23 00:00:00", 1),
            ("b", "2015-03-23 01:00:00.5", 1),
            ("b", None, 1),
            (None, "2015-03-23 00:00:00", 1),
            (None, "2015-03-23 02:00:00", 1),
        ]
    )
    rows = gw.find_gaps(data).collect()
    assert {r["wban"] for r in rows} == {"b", None} and len(rows) == 2
    with pytest.raises(ValueError):
        gw.find_gaps(data, -1)


def random_readings(seed, n=120, hours=40, missing=0.3):
    rng = random.Random(seed)
    start = datetime(2015, 3, 7, 20)
    rows = {}
    for _ in range(n):
        key = rng.choice("aaab")
        t = start + timedelta(microseconds=rng.randrange(hours * 3_600_000_000))
        if rng.random() < 0.3:
            t = t.replace(minute=rng.choice([0, 30]), second=0, microsecond=0)
        rows.setdefault((key, t), None if rng.random() < missing else float(rng.randrange(-50, 50)))
    rows = [(k, t, v) for (k, t), v in rows.items()]
    return rows + rows[:10]  # some exact copies


@pytest.mark.parametrize("fan, top", [(2, 1), (4, 1000), (2**20, 2**27)])
def test_gaps_match_brute_force_at_every_level(readings, fan, top):
    rows = random_readings(1)
    data = readings(rows)
    for threshold in (0, 600, 3600) if top == 2**27 else (600,):
        found = sorted(tuple(r) for r in gw.find_gaps(data, threshold, fan=max(fan, 2), top=top).collect())
        assert found == gaps(rows, threshold)


def test_previous_reading_matches_lag(readings):
    rows = random_readings(2)
    found = gw.previous_reading(readings(rows)).collect()
    lagged = []
    for r in found:
        lagged += [(r["wban"], r["datetime"], r["previous_datetime"])]
        lagged += [(r["wban"], r["datetime"], r["datetime"])] * (r["copies"] - 1)
    expected = []
    for key in "ab":
        times = sorted(t for w, t, _ in rows if w == key)
        expected += [(key, t, p) for t, p in zip(times, [None, *times])]
    no_time = datetime.min
    order = lambda r: (r[0], r[1], r[2] or no_time)
    assert sorted(lagged, key=order) == sorted(expected, key=order)


# -- filling against the row-wise semantics -------------------------------------------


START, END = datetime(2015, 3, 7, 21), datetime(2015, 3, 9, 6)


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-6)


@pytest.mark.parametrize("seed, step, block", [(3, HOUR, 65_536), (4, 6 * HOUR, 3), (5, timedelta(minutes=10), 7)])
def test_summaries_match_brute_force(readings, seed, step, block):
    rows = random_readings(seed)
    start = datetime(2015, 3, 7, 18)
    expected = summary(filled(aligned(rows, start, END, step)))
    got = gw.interpolate_series(
        readings(rows), start, END, step, on_degenerate="null", block_slices=block
    ).collect()
    assert len(got) == len(expected)
    for r in got:
        assert all(close(a, b) for a, b in zip(tuple(r)[2:], expected[tuple(r)[:2]])), r
    custom = gw.interpolate_series(
        readings(rows), start, END, step, on_degenerate="null", aggs={"lo": F.min, "n": "count"}
    )
    named = gw.interpolate_series(
        readings(rows), start, END, step, on_degenerate="null", aggs={"lo": "min", "n": "count"}
    )
    assert sorted(map(str, custom.collect())) == sorted(map(str, named.collect()))


@pytest.mark.parametrize("anchors", ["paired", "independent"])
@pytest.mark.parametrize("method", ["linear", "forward", "backward"])
def test_rows_match_brute_force(readings, method, anchors):
    rows = random_readings(6)
    step = 2 * HOUR
    start = datetime(2015, 3, 7, 20)
    expected = filled(aligned(rows, start, END, step), method, anchors)
    got = gw.fill_series(
        readings(rows), start, END, step, method=method, anchors=anchors, on_degenerate="null", block_slices=4
    ).collect()

    def order(r):
        return tuple((v is None, v if v is not None else 0) for v in tuple(r)[:4] if not isinstance(v, datetime)), [
            v or datetime.min for v in tuple(r)[1:3]
        ]

    got, expected = sorted(got, key=order), sorted(expected, key=order)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert tuple(g)[:4] == e[:4] and close(g["filled"], e[4]), (g, e)


def test_align_keeps_every_reading_and_extra_columns(readings):
    rows = random_readings(7)
    data = readings(rows).withColumn("note", F.lit("x"))
    got = gw.align_to_series(data, START, END, HOUR)
    expected = aligned(rows, START, END, HOUR)
    assert sorted((r["wban"], r["slice"], str(r["datetime"])) for r in got.collect()) == sorted(
        (k, s, str(t)) for k, s, t, _ in expected
    )
    assert got.where("note IS NULL").count() == sum(t is None for _, _, t, _ in expected)


def test_independent_of_partitioning_and_zone(spark, readings):
    rows = random_readings(8)
    # Different values at one instant: the choice must not depend on the partitioning.
    rows += [(k, t, None if v is None else v + 1) for k, t, v in rows[:30]]
    zone = spark.conf.get("spark.sql.session.timeZone")
    results = []
    try:
        for partitions, session_zone in ((1, "UTC"), (7, "America/New_York"), (3, "Asia/Tokyo")):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            df = gw.interpolate_series(readings(rows, partitions), START, END, HOUR, on_degenerate="null")
            results.append(sorted((r[0], r[1], *(v and round(v, 6) for v in r[2:])) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert results[0] == results[1] == results[2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    minutes=hs.lists(hs.integers(0, 30 * 60), min_size=2, max_size=25, unique=True),
    slope=hs.integers(-5, 5),
    offset=hs.integers(-50, 50),
)
def test_linear_data_is_filled_exactly(readings, minutes, slope, offset):
    start = datetime(2015, 3, 23)
    data = readings([("s", start + timedelta(minutes=m), slope * m + offset) for m in minutes])
    first, last = min(minutes), max(minutes)
    for r in gw.interpolate(data, start, start + timedelta(hours=30), HOUR).collect():
        at = (r["slice"] - start) / timedelta(minutes=1)
        if r["temperature"] is not None:
            assert r["filled"] == r["temperature"]
        elif first < at < last:
            assert close(r["filled"], slope * at + offset)


# -- summaries without filling ----------------------------------------------------------


def test_resample_and_first_last(readings):
    data = readings(
        [("s", "2015-03-23 00:10", 10), ("s", "2015-03-23 00:20", 20), ("s", "2015-03-23 00:40", None)]
    )
    row = gw.resample(data, HOUR, {"lo": "min", "hi": "max", "mean": "avg", "n": "count"}).first()
    assert tuple(row)[2:] == (10, 20, 15, 2)
    row = data.groupBy("wban").agg(
        gw.first_non_null("temperature", "datetime"), gw.last_non_null("temperature", "datetime")
    )
    assert tuple(row.first()) == ("s", 10, 20)
