
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import gapweave as gw  # noqa: E402
from gapweave.functions.scalar import cell_is_valid  # noqa: E402
from gapweave.functions.sql import register  # noqa: E402
from gapweave.plans import standins as st  # noqa: E402
from gapweave.plans.ingest import to_observations, with_station  # noqa: E402
from gapweave.schemas import STATION, create_tables  # noqa: E402
from gapweave.session import kept, scratch_path  # noqa: E402
from gapweave.sources.versions import canonical  # noqa: E402
from gapweave.streaming.ingest import hourly_stream  # noqa: E402

try:  # the text operators are optional: their folder may be taken away
    from gapweave.llm import queries as text_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("gapweave.llm", "gapweave.llm.queries"):
        raise
    text_queries = None
try:
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "gapweave.llm"):
        raise
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
START, END = "2024-01-01", "2024-01-30 23:00:00"
ONE = "7"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def temps(df: DataFrame) -> DataFrame:
    return rounded(df, "min_temp", "max_temp", "avg_temp")


def interpolate_all(spark: SparkSession, folder: str) -> DataFrame:
    return temps(gw.interpolate_series(st.weather(spark, folder), START, END, HOUR))


def entry(spark: SparkSession) -> DataFrame:
    """Every series of sf0.001 in hourly slices, gaps filled on the straight line."""
    return interpolate_all(spark, "/root/testdata/sf0.001")


# -- gaps -----------------------------------------------------------------------


def gaps(threshold_s: float) -> Query:
    return lambda spark, folder: gw.find_gaps(st.weather(spark, folder), threshold_s)


def gap_detect_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The gaps after three batches, each of which holds readings of all times."""
    readings = st.weather(spark, folder)
    state = gw.GapState(spark, scratch_path(spark, "gaps"), 3600)
    for n in range(3):
        state.add(readings.where(F.col("event_id") % 3 == n))
    return state.gaps()


def interpolate_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The filled summaries after three batches, each of which holds readings of all times."""
    readings = st.weather(spark, folder, with_missing=True)
    state = gw.ResampleState(spark, scratch_path(spark, "summaries"), START, END, HOUR, block_slices=240)
    for n in range(3):
        state.add(readings.where(F.col("event_id") % 3 == n))
    return temps(state.result())


def previous_reading(spark: SparkSession, folder: str) -> DataFrame:
    return gw.previous_reading(st.weather(spark, folder))


def previous_reading_rows(spark: SparkSession, folder: str) -> DataFrame:
    return gw.previous_reading_rows(st.weather(spark, folder))


# -- slices -----------------------------------------------------------------------


def time_slice(rounding: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return st.weather(spark, folder).select(
            "event_id", gw.time_slice("datetime", HOUR, rounding).alias("slice")
        )

    return run


def dense_series_1h(spark: SparkSession, folder: str) -> DataFrame:
    return gw.dense_series(st.stations(spark, folder).select("wban"), START, END, HOUR)


def dense_series_1s(spark: SparkSession, folder: str) -> DataFrame:
    """More slices than one block holds, for every supplier, counted by the hour."""
    keys = st.table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("wban"))
    seconds = gw.dense_series(keys, START, "2024-01-01 20:00:00", timedelta(seconds=1))
    hours = seconds.groupBy("wban", gw.slice_micros("slice", HOUR, "floor").alias("hour_us")).agg(
        F.count(F.lit(1)).alias("slices"), F.min("slice").alias("first"), F.max("slice").alias("last")
    )
    return hours.select("wban", gw.time_slice("first", HOUR, "floor").alias("hour"), "slices", "first", "last")


def align_series(spark: SparkSession, folder: str) -> DataFrame:
    readings = st.weather(spark, folder).drop("event_id", "skycondition")
    return gw.align_to_series(readings, START, END, HOUR)


def fill(method: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        filled = gw.fill_series(
            st.weather(spark, folder, with_missing=True), START, END, HOUR, method=method
        )
        return rounded(filled.select("wban", "slice", "datetime", F.col("filled").alias("value")), "value")

    return run


# -- resampling ---------------------------------------------------------------------


def interpolate(with_missing: bool, step: timedelta = HOUR, **options) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        readings = st.weather(spark, folder, with_missing)
        return temps(gw.interpolate_series(readings, START, END, step, **options))

    return run


def interpolate_unaligned(spark: SparkSession, folder: str) -> DataFrame:
    return gw.interpolate_series(
        st.weather(spark, folder), "2024-01-01 00:15:00", END, HOUR, strict_alignment=False
    )


def interpolate_chosen(spark: SparkSession, folder: str) -> DataFrame:
    chosen = st.stations(spark, folder, "FURNITURE").select("wban")
    return temps(gw.interpolate_series(st.weather(spark, folder), START, END, HOUR, chosen))


def interpolate_one_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """One station out of a table laid out by station and time."""
    target = scratch_path(spark, "clustered")
    rows = st.weather(spark, folder).withColumns({"windspeed": F.lit(None), "stationpressure": F.lit(None)})
    gw.write_weather_clustered(rows, target, 32)
    # as far as readings are rounded into the slices of the range
    readings = gw.read_weather_clustered(spark, target, [ONE], "2023-12-31 23:59:59", "2024-01-31 00:00:01")
    return temps(gw.interpolate_series(readings, START, END, HOUR, [ONE]))


def resample_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Sketched quartiles of each kind of reading a week, and whether their exact ranks are near."""
    week, aggs = timedelta(days=7), {f"q{int(100 * q)}": gw.quantile(q) for q in (0.25, 0.5, 0.75)}
    readings = st.weather(spark, folder, with_missing=True).where("temperature IS NOT NULL")
    found = gw.resample(readings, week, aggs, key="skycondition", rounding="floor")
    placed = readings.select("skycondition", gw.time_slice("datetime", week, "floor").alias("slice"), "temperature")
    ranks = {c: (F.count_if(F.col("temperature") <= F.col(c)) / F.count(F.lit(1)) - int(c[1:]) / 100) for c in aggs}
    near = {c: F.abs(rank) <= 0.05 + 1 / F.count(F.lit(1)) for c, rank in ranks.items()}
    return placed.join(found, ["skycondition", "slice"]).groupBy("skycondition", "slice").agg(
        F.count(F.lit(1)).alias("n"), *[ok.alias(f"{c}_near") for c, ok in near.items()]
    )


def interpolate_more_aggs(spark: SparkSession, folder: str) -> DataFrame:
    aggs = {"n": "count", "total": "sum", "median_temp": F.median, "sd_temp": F.stddev_samp}
    readings = st.weather(spark, folder, with_missing=True)
    return rounded(
        gw.interpolate_series(readings, START, END, DAY, aggs=aggs), "total", "median_temp", "sd_temp"
    )


def interpolate_count_sum(spark: SparkSession, folder: str) -> DataFrame:
    readings = st.weather(spark, folder, with_missing=True)
    return rounded(
        gw.interpolate_series(readings, START, END, DAY, aggs={"n": "count", "total": "sum"}), "total"
    )


def resample_min_max_avg(spark: SparkSession, folder: str) -> DataFrame:
    aggs = {"min_temp": "min", "max_temp": "max", "avg_temp": "avg", "n": "count"}
    return temps(gw.resample(st.weather(spark, folder, with_missing=True), DAY, aggs))


def first_last(pick: Callable, name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        readings = st.weather(spark, folder, with_missing=True)
        return readings.groupBy("wban").agg(
            pick("temperature", "datetime").alias(f"{name}_v"),
            pick("skycondition", "datetime").alias(f"{name}_sky"),
        )

    return run


# -- stations -----------------------------------------------------------------------


def order_stations(spark: SparkSession, folder: str) -> DataFrame:
    return st.table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("wban"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderkey").alias("position"),
    )


def dedupe_first_station(spark: SparkSession, folder: str) -> DataFrame:
    return gw.dedupe_first(order_stations(spark, folder), "wban", "position").select("wban", "name")


def known_station_semi(spark: SparkSession, folder: str) -> DataFrame:
    known = st.stations(spark, folder, "FURNITURE")
    return gw.known_stations(st.weather(spark, folder), known).select("event_id", "wban", "datetime")


def enrich_station(spark: SparkSession, folder: str) -> DataFrame:
    nested = gw.with_station_struct(st.stations(spark, folder))
    return gw.enrich_with_station(st.weather(spark, folder), nested, unique=True).select(
        "event_id",
        "wban",
        F.col("station.name").alias("name"),
        F.col("station.geo_location.lat").alias("lat"),
        F.col("station.geo_location.lon").alias("lon"),
    )


def new_station_anti(spark: SparkSession, folder: str) -> DataFrame:
    known = st.weather(spark, folder)
    return gw.new_stations(st.stations(spark, folder), known).select("wban", "name")


def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = st.stations(spark, folder).select("wban", "name")
    return gw.assign_station_id(rows).select("wban", "station_id")


def upsert_stations(spark: SparkSession, folder: str) -> DataFrame:
    orders = order_stations(spark, folder)
    there = gw.assign_station_id(st.stations(spark, folder, "FURNITURE").select("wban", "name", "state"))
    return gw.upsert_stations(orders, there, "position")


def upsert_written(spark: SparkSession, folder: str) -> DataFrame:
    """The station table after an upsert has been appended to it and read back."""
    target = scratch_path(spark, "stations")
    there = gw.assign_station_id(st.stations(spark, folder, "FURNITURE").select("wban", "name", "state"))
    gw.append_stations(there, target)
    gw.append_stations(gw.upsert_stations(order_stations(spark, folder), spark.read.parquet(target), "position"), target)
    return spark.read.parquet(target).select("wban", "name", "state")


def upsert_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    """Two writers that started from the same version: the second commit is refused and made again."""
    state = F.struct("name", "state")
    schema = T.StructType([f for f in STATION if f.name in ("station_id", "wban", "name", "state")])
    table = gw.StationTable(spark, scratch_path(spark, "stations"), schema)
    customers = st.stations(spark, folder).where("state <> 'BUILDING'")
    early = table.prepare(customers, state)
    table.upsert(order_stations(spark, folder), "position")
    if table.commit(early):
        raise AssertionError("a commit to a version that is gone by was taken")
    table.upsert(customers, state)
    return table.read()


def table_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """The two tables created in a database of their own, filled, and read back by name."""
    database = f"gapweave_{uuid.uuid4().hex}"
    create_tables(spark, database, scratch_path(spark, "database"))
    heights = {"ground_height": F.lit(12), "station_height": F.lit(None).cast("int")}
    stations = gw.assign_station_id(gw.to_station_rows(st.stations(spark, folder).withColumns(heights)))
    table = spark.table(f"{database}.station")
    stations.select(*table.columns).write.insertInto(f"{database}.station")
    rows = st.weather(spark, folder, with_missing=True).withColumns(
        {"windspeed": F.lit(None), "stationpressure": F.lit(None)}
    )
    gw.append_weather_table(rows, f"{database}.weather_data")
    joined = spark.table(f"{database}.weather_data").join(spark.table(f"{database}.station"), "wban")
    return joined.groupBy("wban", "name").agg(
        F.count("temperature").alias("known"), F.count(F.lit(1)).alias("n"), F.max("datetime").alias("latest")
    )


def unique_violations(spark: SparkSession, folder: str) -> DataFrame:
    return gw.check_unique(order_stations(spark, folder), "wban")


def null_violations(spark: SparkSession, folder: str) -> DataFrame:
    readings = st.weather(spark, folder, with_missing=True)
    return gw.check_not_null(readings, "wban", "datetime", "temperature")


# -- scalar functions -----------------------------------------------------------------


def per_event(**columns: Callable[[], object]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        events = st.table(spark, folder, "events")
        return events.select("event_id", *[make().alias(name) for name, make in columns.items()])

    return run


NOON = "TIMESTAMP_NTZ'2024-01-15 12:00:00.25'"


def seconds_between():
    return gw.datediff_seconds("ts", F.expr(NOON))


def lin_interp_scalar():
    x = (F.col("event_id") % 100).cast("double")
    return F.round(
        gw.linear_interpolate(x, F.lit(0.0), F.col("value"), x + 1.5, F.col("user_id").cast("double")), 6
    )


def lin_interp_ts():
    start, end = F.expr("TIMESTAMP_NTZ'2024-01-01'"), F.expr("TIMESTAMP_NTZ'2024-01-31'")
    return F.round(gw.linear_interpolate_ts("ts", start, F.lit(10.0), end, F.col("value")), 6)


def to_utc():
    offset = F.col("user_id") % 25 - 12
    return F.unix_micros(gw.to_utc("ts", offset))


def parsed_datetime():
    date = F.when(F.col("event_type") == "view", F.lit("20240231")).otherwise(st.date_cell("ts"))
    time = F.when(F.col("event_type") == "click", F.lit("2400")).otherwise(st.time_cell("ts"))
    return gw.parse_datetime(date, time)


def number_cell():
    kind, text = F.col("event_type"), F.col("value").cast("string")
    padded = F.concat(F.lit(" "), text, F.lit("\t"))
    return (
        F.when(kind == "error", F.lit("M")).when(kind == "view", F.concat(text, F.lit("s"))).otherwise(padded)
    )


def blank_test(spark: SparkSession, folder: str) -> DataFrame:
    lines = st.table(spark, folder, "documents").select(
        "doc_id", F.explode(F.split("text", "\n", -1)).alias("line")
    )
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(gw.is_blank("line")).alias("blank_lines")
    )


# -- files, tables, streams ---------------------------------------------------------------


def as_result(rows: DataFrame) -> DataFrame:
    numbers = ("temperature", "windspeed", "stationpressure")
    return rows.select(
        "wban", "datetime", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in numbers], "skycondition"
    )


def read_stations(spark: SparkSession, folder: str) -> DataFrame:
    valid, rejected = gw.read_stations(spark, st.write_station_files(spark, folder))
    columns = ["wban", "name", "state", "latitude", "ground_height", "barometer"]
    good = valid.select(*columns, F.lit(True).alias("ok"))
    bad = rejected.select(
        *("wban", "name", "state"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("ground_height").cast("int").alias("ground_height"),
        F.col("barometer").cast("int").alias("barometer"),
        F.lit(False).alias("ok"),
    )
    return good.unionAll(bad).withColumn("latitude", F.col("latitude").cast("double"))


def read_hourly_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = gw.read_hourly(spark, st.write_hourly_files(spark, folder))
    return rejected.select("wban", "date", "time", "sky_condition")


def ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    hourly, stations = st.write_hourly_files(spark, folder), st.write_station_files(spark, folder)
    return as_result(gw.ingest(spark, hourly, stations))


def ingest_enriched(spark: SparkSession, folder: str) -> DataFrame:
    hourly, _ = gw.read_hourly(spark, st.write_hourly_files(spark, folder))
    stations = gw.load_stations(spark, st.write_station_files(spark, folder))
    observed = with_station(to_observations(hourly), stations)
    return observed.select(
        F.col("station.wban").alias("wban"),
        F.col("station.name").alias("name"),
        "date",
        F.col("station.geo_location.lat").alias("lat"),
        F.round(F.col("temperature").cast("double"), 3).alias("temperature"),
    )


def ingest_stream(spark: SparkSession, folder: str) -> DataFrame:
    hourly = st.write_hourly_files(spark, folder)
    stations = gw.load_stations(spark, st.write_station_files(spark, folder))
    target = scratch_path(spark, "weather")
    running = gw.stream_ingest(spark, hourly, stations, target, every=None, max_files=2)
    running.awaitTermination()
    return as_result(gw.read_weather(spark, target))


def ingest_stream_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two calls on one folder, the second with another number of files a batch: nothing is lost or repeated."""
    hourly = st.write_hourly_files(spark, folder)
    stations = gw.load_stations(spark, st.write_station_files(spark, folder))
    target = scratch_path(spark, "weather")
    for files in (2, 3):
        gw.stream_ingest(spark, hourly, stations, target, every=None, max_files=files).awaitTermination()
    return as_result(gw.read_weather(spark, target))


def ingest_stream_renamed(spark: SparkSession, folder: str) -> DataFrame:
    """One folder asked for by four names: as it is, through the folder above, by a pattern, and with its store."""
    hourly = st.write_hourly_files(spark, folder)
    stations = gw.load_stations(spark, st.write_station_files(spark, folder))
    target = scratch_path(spark, "weather")
    name = hourly.rsplit("/", 1)[1]
    for spelled in (hourly, f"{hourly}/../{name}/", f"{hourly}/*.csv", canonical(spark, hourly)):
        gw.stream_ingest(spark, spelled, stations, target, every=None).awaitTermination()
    return as_result(gw.read_weather(spark, target))


def ingest_stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Appended batches of at most 100 records: all rows, the largest batch, and what the ledger knows of."""
    hourly = st.write_hourly_files(spark, folder)
    stations = gw.load_stations(spark, st.write_station_files(spark, folder))
    target = scratch_path(spark, "weather")
    gw.stream_ingest(spark, hourly, stations, target, every=None, max_files=2, batch_rows=100).awaitTermination()
    sizes = spark.read.parquet(target).groupBy("query", "batch", "split").agg(F.count(F.lit(1)).alias("n"))
    stored = sizes.agg(F.sum("n").alias("rows"), (F.max("n") <= 100).alias("capped"))
    taken = gw.TakenFiles(spark, target).read().groupBy("query", "batch", "split").agg(F.sum("records").alias("n"))
    known = taken.agg(F.sum("n").alias("records"), (F.max("n") <= 100).alias("records_capped"))
    return stored.crossJoin(known)


def ingest_stream_new_stations(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose stations come while it runs: the second call's files meet those that the first didn't know."""
    hourly = st.write_hourly_files(spark, folder)
    stations = gw.load_stations(spark, st.write_station_files(spark, folder)).select("wban", "name", "state")
    schema = T.StructType([f for f in STATION if f.name in ("station_id", "wban", "name", "state")])
    table = gw.StationTable(spark, scratch_path(spark, "stations"), schema)
    target = scratch_path(spark, "weather")
    table.upsert(stations.where("state = 'AUTOMOBILE'"), F.col("name"))
    gw.stream_ingest(spark, hourly, table, target, every=None, max_files=2).awaitTermination()
    table.upsert(stations, F.col("name"))
    gw.stream_ingest(spark, f"{st.write_hourly_files(spark, folder)}/*.csv", table, target, every=None).awaitTermination()
    return as_result(gw.read_weather(spark, target))


def stream_static_join(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of hourly files joined with the static station table, written as it arrives."""
    hourly = st.write_hourly_files(spark, folder)
    stations = kept(gw.load_stations(spark, st.write_station_files(spark, folder)).select("wban", "name"), "names")
    target = scratch_path(spark, "joined")
    rows = hourly_stream(spark, hourly, max_files=2).join(stations, "wban").select("wban", "name", "datetime")
    running = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(target)


def write_and_read_weather(spark: SparkSession, folder: str) -> DataFrame:
    rows = st.weather(spark, folder, with_missing=True).withColumns(
        {"windspeed": F.lit(None), "stationpressure": F.lit(None)}
    )
    target = scratch_path(spark, "weather")
    gw.write_weather(rows, target, by_day=True)
    return as_result(gw.read_weather(spark, target, "2024-01-10", "2024-01-20 12:00:00"))


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    st.table(spark, folder, "events").createOrReplaceTempView("gapweave_events")
    return spark.sql(
        f"""
        SELECT event_id, datediff_seconds(ts, {NOON}) AS diff, timestamp_to_seconds(ts) AS seconds,
               round(linear_interpolate(1, 0, value, 2, 20), 6) AS line,
               round(linear_interpolate_ts(ts, TIMESTAMP_NTZ'2024-01-01', 10,
                                           TIMESTAMP_NTZ'2024-01-31', value), 6) AS line_ts
        FROM gapweave_events
        """
    )


def sql_interpolate_one(spark: SparkSession, folder: str) -> DataFrame:
    st.weather(spark, folder).createOrReplaceTempView("gapweave_weather")
    register(spark, "gapweave_weather")
    return temps(
        spark.sql(
            f"SELECT * FROM interpolate_temperature('{ONE}', TIMESTAMP_NTZ'{START}', "
            f"TIMESTAMP_NTZ'{END}', INTERVAL '1' HOUR)"
        )
    )


def sql_interpolate_missing(step: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        st.weather(spark, folder, with_missing=True).createOrReplaceTempView("gapweave_missing")
        register(spark, "gapweave_missing")
        return temps(
            spark.sql(
                f"SELECT * FROM interpolate_temperature('{ONE}', TIMESTAMP_NTZ'{START}', "
                f"TIMESTAMP_NTZ'{END}', INTERVAL '1' {step})"
            )
        )

    return run


def queries() -> dict[str, Query]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    found = series_queries()
    if text_queries:
        found |= text_queries.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def series_queries() -> dict[str, Query]:
    return {
        "gap_detect_1h": gaps(3600),
        "gap_detect_1d": gaps(86_400),
        "gap_detect_half_second": gaps(0.5),
        "gap_detect_incremental": gap_detect_incremental,
        "previous_reading": previous_reading,
        "previous_reading_rows": previous_reading_rows,
        "time_slice_ref": time_slice("reference"),
        "time_slice_floor": time_slice("floor"),
        "dense_series_1h": dense_series_1h,
        "dense_series_1s": dense_series_1s,
        "align_series": align_series,
        "fill_forward": fill("forward"),
        "fill_backward": fill("backward"),
        "interpolate_rows": fill("linear"),
        "interpolate_one": interpolate(False, keys=[ONE], ordered=True),
        "interpolate_all": interpolate_all,
        "interpolate_in_blocks": interpolate(False, block_slices=100),
        "interpolate_chosen": interpolate_chosen,
        "interpolate_unaligned": interpolate_unaligned,
        "interpolate_missing_paired": interpolate(True),
        "interpolate_incremental": interpolate_incremental,
        "interpolate_missing_paired_1d": interpolate(True, DAY),
        "interpolate_missing_independent": interpolate(True, anchors="independent", on_degenerate="null"),
        "interpolate_count_sum": interpolate_count_sum,
        "interpolate_more_aggs": interpolate_more_aggs,
        "resample_min_max_avg": resample_min_max_avg,
        "resample_quantiles": resample_quantiles,
        "interpolate_one_clustered": interpolate_one_clustered,
        "first_non_null": first_last(gw.first_non_null, "first"),
        "last_non_null": first_last(gw.last_non_null, "last"),
        "dedupe_first_station": dedupe_first_station,
        "known_station_semi": known_station_semi,
        "enrich_station": enrich_station,
        "new_station_anti": new_station_anti,
        "surrogate_key": surrogate_key,
        "upsert_stations": upsert_stations,
        "upsert_written": upsert_written,
        "upsert_two_writers": upsert_two_writers,
        "table_definitions": table_definitions,
        "unique_violations": unique_violations,
        "null_violations": null_violations,
        "seconds_between": per_event(value=seconds_between),
        "epoch_seconds": per_event(value=lambda: gw.timestamp_to_seconds("ts")),
        "lin_interp_scalar": per_event(value=lin_interp_scalar),
        "lin_interp_ts": per_event(value=lin_interp_ts),
        "to_utc": per_event(value=to_utc),
        "parse_datetime": per_event(datetime=parsed_datetime),
        "missing_sentinel": per_event(
            value=lambda: gw.parse_missing(number_cell(), "double", ("M",)),
            valid=lambda: cell_is_valid(number_cell(), "double", ("M",)),
        ),
        "blank_test": blank_test,
        "read_stations": read_stations,
        "read_hourly_rejects": read_hourly_rejects,
        "ingest_csv": ingest_csv,
        "ingest_enriched": ingest_enriched,
        "ingest_stream": ingest_stream,
        "ingest_stream_twice": ingest_stream_twice,
        "ingest_stream_renamed": ingest_stream_renamed,
        "ingest_stream_batches": ingest_stream_batches,
        "ingest_stream_new_stations": ingest_stream_new_stations,
        "stream_static_join": stream_static_join,
        "write_and_read_weather": write_and_read_weather,
        "sql_functions": sql_functions,
        "sql_interpolate_one": sql_interpolate_one,
        "sql_interpolate_missing_1h": sql_interpolate_missing("HOUR"),
        "sql_interpolate_missing_1d": sql_interpolate_missing("DAY"),
    }


# -- oracles -------------------------------------------------------------------------------

READINGS = """readings AS (
  SELECT event_id, user_id::VARCHAR AS wban, ts AS datetime, value AS temperature, event_type FROM events)"""
WITH_MISSING = READINGS.replace(
    "value AS temperature", "CASE WHEN event_type <> 'error' THEN value END AS temperature"
)


def slice_sql(seconds: int) -> str:
    return f"make_timestamp((round_even(epoch(datetime), 0)::BIGINT // {seconds} * {seconds}) * 1000000)"


def gap_sql(seconds: float) -> str:
    return f"""WITH {READINGS}, lagged AS (
  SELECT wban, datetime AS current_datetime,
         lag(datetime) OVER (PARTITION BY wban ORDER BY datetime) AS previous_datetime FROM readings)
SELECT * FROM lagged WHERE epoch_us(current_datetime) - epoch_us(previous_datetime) > {int(seconds * 1e6)}"""


ALL_KEYS = "SELECT DISTINCT wban FROM readings"
RANGE_KEYS = f"""{ALL_KEYS} WHERE {slice_sql(3600)} BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"""


def aligned_sql(readings: str, keys: str, seconds: int, end: str = END) -> str:
    """The readings in range with their slice, and the slices without any."""
    return f"""{readings},
series AS ({keys}),
inside AS (SELECT wban, {slice_sql(seconds)} AS slice, datetime, temperature FROM readings
           WHERE wban IN (SELECT wban FROM series) AND slice BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{end}'),
vacant AS (SELECT wban, slot AS slice FROM series,
             generate_series(TIMESTAMP '{START}', TIMESTAMP '{end}', INTERVAL {seconds} SECOND) AS g(slot)
           EXCEPT SELECT wban, slice FROM inside),
aligned AS (FROM inside UNION ALL BY NAME FROM vacant)"""


def filled_sql(readings: str, keys: str, seconds: int, anchors: str = "paired", end: str = END) -> str:
    """Every row without a value looks up the nearest reading with one on either side."""
    nearest = "k0.datetime AS t0, k1.datetime AS t1"
    others = ""
    if anchors == "independent":
        nearest = "r0.datetime AS t0, r1.datetime AS t1"
        others = """
  ASOF LEFT JOIN seen r0 ON u.wban = r0.wban AND u.at >= r0.datetime
  ASOF LEFT JOIN seen r1 ON u.wban = r1.wban AND u.at <= r1.datetime"""
    return f"""{aligned_sql(readings, keys, seconds, end)},
seen AS (SELECT wban, datetime FROM inside GROUP BY ALL),
known AS (SELECT wban, datetime, any_value(temperature) AS y FROM inside
          WHERE temperature IS NOT NULL GROUP BY wban, datetime),
unknown AS (SELECT wban, slice, datetime, coalesce(datetime, slice) AS at FROM aligned WHERE temperature IS NULL),
looked_up AS (
  SELECT u.wban, u.slice, u.datetime, k0.y AS y0, k1.y AS y1, {nearest}
  FROM unknown u
  ASOF LEFT JOIN known k0 ON u.wban = k0.wban AND u.at >= k0.datetime
  ASOF LEFT JOIN known k1 ON u.wban = k1.wban AND u.at <= k1.datetime{others}),
filled AS (
  SELECT wban, slice, datetime, temperature AS linear, temperature AS forward, temperature AS backward
  FROM inside WHERE temperature IS NOT NULL
  UNION ALL
  SELECT wban, slice, datetime,
         y0 + (y1 - y0) * (epoch(slice) - epoch(t0)) / nullif(epoch(t1) - epoch(t0), 0), y0, y1 FROM looked_up)"""


# r_wban, r_slice, min_temp, max_temp and avg_temp are fixed names of the result.
def interpolate_sql(readings: str = READINGS, keys: str = ALL_KEYS, seconds: int = 3600, **options) -> str:
    return f"""WITH {filled_sql(readings, keys, seconds, **options)}
SELECT wban AS r_wban, slice AS r_slice, round(min(linear), 6) AS min_temp,
       round(max(linear), 6) AS max_temp, round(avg(linear), 6) AS avg_temp
FROM filled GROUP BY wban, slice"""


def fill_sql(method: str) -> str:
    return f"""WITH {filled_sql(WITH_MISSING, ALL_KEYS, 3600)}
SELECT wban, slice, datetime, round({method}, 6) AS value FROM filled"""


def more_aggs_sql(columns: str) -> str:
    return f"""WITH {filled_sql(WITH_MISSING, ALL_KEYS, 86400)}
SELECT wban AS r_wban, slice AS r_slice, {columns} FROM filled GROUP BY wban, slice"""


def first_last_sql(how: str, name: str) -> str:
    return f"""WITH {WITH_MISSING}
SELECT wban, {how}(temperature, datetime) FILTER (WHERE temperature IS NOT NULL) AS {name}_v,
       {how}(event_type, datetime) AS {name}_sky
FROM readings GROUP BY wban"""


LINE_TS = """round((value - 10) / (epoch(TIMESTAMP '2024-01-31') - epoch(TIMESTAMP '2024-01-01'))
         * (epoch(ts) - epoch(TIMESTAMP '2024-01-01')) + 10, 6)"""
DIFF = "(epoch_us(TIMESTAMP '2024-01-15 12:00:00.25') - epoch_us(ts)) / 1e6"
FURNITURE = "SELECT c_custkey::VARCHAR AS wban, c_name AS name FROM customer WHERE c_mktsegment = 'FURNITURE'"
FILE_STATIONS = (
    "SELECT c_custkey::VARCHAR FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'BUILDING')"
)
ORDER_STATIONS = """(SELECT o_custkey::VARCHAR AS wban, 'Order ' || o_orderkey AS name, o_orderstatus AS state,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)"""
INGESTED = f"""SELECT user_id::VARCHAR AS wban, date_trunc('minute', ts) AS datetime,
  CASE WHEN event_type <> 'error' THEN round(value::FLOAT::DOUBLE, 3) END AS temperature,
  (event_id % 40)::DOUBLE AS windspeed, CASE WHEN event_type <> 'view' THEN 29.92::DOUBLE END AS stationpressure,
  event_type AS skycondition
FROM events WHERE event_type <> 'signup' AND user_id::VARCHAR IN ({FILE_STATIONS})"""


def oracle_sql() -> dict[str, str]:
    """For each query that SQL can express, the SQL DuckDB runs on the same tables."""
    found = series_sql()
    if text_queries:
        found |= text_queries.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def series_sql() -> dict[str, str]:
    return {
        "gap_detect_1h": gap_sql(3600),
        "gap_detect_1d": gap_sql(86_400),
        "gap_detect_half_second": gap_sql(0.5),
        "gap_detect_incremental": gap_sql(3600),
        "previous_reading": f"""WITH {READINGS}, instants AS (
  SELECT wban, datetime, count(*) AS copies FROM readings GROUP BY ALL)
SELECT wban, datetime, lag(datetime) OVER (PARTITION BY wban ORDER BY datetime) AS previous_datetime, copies
FROM instants""",
        "previous_reading_rows": f"""WITH {READINGS}
SELECT event_id, wban, datetime, temperature, event_type AS skycondition,
       lag(datetime) OVER (PARTITION BY wban ORDER BY datetime) AS previous_datetime FROM readings""",
        "time_slice_ref": f"WITH {READINGS} SELECT event_id, {slice_sql(3600)} AS slice FROM readings",
        "time_slice_floor": """SELECT event_id,
  time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS slice FROM events""",
        "dense_series_1h": f"""SELECT wban, unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}',
  INTERVAL 1 HOUR)) AS slice FROM (SELECT c_custkey::VARCHAR AS wban FROM customer)""",
        "dense_series_1s": f"""SELECT wban, date_trunc('hour', slice) AS hour, count(*) AS slices,
  min(slice) AS first, max(slice) AS last
FROM (SELECT s_suppkey::VARCHAR AS wban, unnest(generate_series(TIMESTAMP '{START}',
  TIMESTAMP '2024-01-01 20:00:00', INTERVAL 1 SECOND)) AS slice FROM supplier) GROUP BY ALL""",
        "align_series": f"""WITH {aligned_sql(READINGS, ALL_KEYS, 3600)}
SELECT wban, slice, datetime, temperature FROM aligned""",
        "fill_forward": fill_sql("forward"),
        "fill_backward": fill_sql("backward"),
        "interpolate_rows": fill_sql("linear"),
        "interpolate_one": interpolate_sql(keys=f"SELECT '{ONE}' AS wban"),
        "interpolate_all": interpolate_sql(),
        "interpolate_in_blocks": interpolate_sql(),
        "interpolate_chosen": interpolate_sql(keys=FURNITURE),
        "interpolate_unaligned": f"""WITH {READINGS}
SELECT wban AS r_wban, unnest(generate_series(TIMESTAMP '2024-01-01 00:15:00', TIMESTAMP '{END}',
  INTERVAL 1 HOUR)) AS r_slice, NULL::DOUBLE AS min_temp, NULL::DOUBLE AS max_temp, NULL::DOUBLE AS avg_temp
FROM ({ALL_KEYS})""",
        "interpolate_missing_paired": interpolate_sql(WITH_MISSING),
        "interpolate_incremental": interpolate_sql(WITH_MISSING, RANGE_KEYS),
        "interpolate_missing_paired_1d": interpolate_sql(WITH_MISSING, seconds=86400),
        "interpolate_missing_independent": interpolate_sql(WITH_MISSING, anchors="independent"),
        "interpolate_count_sum": more_aggs_sql("count(linear) AS n, round(sum(linear), 6) AS total"),
        "interpolate_more_aggs": more_aggs_sql(
            "count(linear) AS n, round(sum(linear), 6) AS total, round(median(linear), 6) AS median_temp, "
            "round(stddev_samp(linear), 6) AS sd_temp"
        ),
        "resample_quantiles": f"""WITH {WITH_MISSING}
SELECT event_type AS skycondition, time_bucket(INTERVAL 7 DAY, datetime, TIMESTAMP '1970-01-01') AS slice, count(*) AS n,
  true AS q25_near, true AS q50_near, true AS q75_near
FROM readings WHERE temperature IS NOT NULL GROUP BY ALL""",
        "interpolate_one_clustered": interpolate_sql(
            READINGS.replace("value AS temperature", "value::FLOAT::DOUBLE AS temperature"), f"SELECT '{ONE}' AS wban"
        ),
        "resample_min_max_avg": f"""WITH {WITH_MISSING}
SELECT wban, {slice_sql(86400)} AS slice, round(min(temperature), 6) AS min_temp,
       round(max(temperature), 6) AS max_temp, round(avg(temperature), 6) AS avg_temp, count(temperature) AS n
FROM readings GROUP BY ALL""",
        "first_non_null": first_last_sql("arg_min", "first"),
        "last_non_null": first_last_sql("arg_max", "last"),
        "dedupe_first_station": f"SELECT wban, name FROM {ORDER_STATIONS} WHERE rn = 1",
        "known_station_semi": f"""WITH {READINGS}
SELECT event_id, wban, datetime FROM readings WHERE wban IN (SELECT wban FROM ({FURNITURE}))""",
        "enrich_station": """SELECT event_id, user_id::VARCHAR AS wban, c_name AS name,
  (c_custkey % 90)::DOUBLE AS lat, (c_custkey % 180)::DOUBLE AS lon
FROM events JOIN customer ON user_id = c_custkey""",
        "new_station_anti": """SELECT c_custkey::VARCHAR AS wban, c_name AS name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
        "surrogate_key": """SELECT wban, (row_number() OVER (ORDER BY substr(md5(wban), 1, 3), wban))::INTEGER
  AS station_id FROM (SELECT c_custkey::VARCHAR AS wban FROM customer)""",
        "upsert_stations": f"""SELECT ((SELECT count(*) FROM ({FURNITURE}))
  + row_number() OVER (ORDER BY substr(md5(wban), 1, 3), wban))::INTEGER AS station_id, wban, name, state
FROM {ORDER_STATIONS} WHERE rn = 1 AND wban NOT IN (SELECT wban FROM ({FURNITURE}))""",
        "upsert_written": f"""SELECT wban, name, state FROM {ORDER_STATIONS}
WHERE rn = 1 AND wban NOT IN (SELECT wban FROM ({FURNITURE}))
UNION ALL SELECT c_custkey::VARCHAR, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'FURNITURE'""",
        "upsert_two_writers": f"""WITH o AS (SELECT wban, name, state FROM {ORDER_STATIONS} WHERE rn = 1),
c AS (SELECT c_custkey::VARCHAR AS wban, c_name AS name, c_mktsegment AS state FROM customer
      WHERE c_mktsegment <> 'BUILDING' AND c_custkey::VARCHAR NOT IN (SELECT wban FROM o))
SELECT row_number() OVER (ORDER BY substr(md5(wban), 1, 3), wban)::INTEGER AS station_id, wban, name, state FROM o
UNION ALL SELECT ((SELECT count(*) FROM o) + row_number() OVER (ORDER BY substr(md5(wban), 1, 3), wban))::INTEGER,
  wban, name, state FROM c""",
        "table_definitions": """SELECT user_id::VARCHAR AS wban, c_name AS name,
  count(*) FILTER (event_type <> 'error') AS known, count(*) AS n, max(ts) AS latest
FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL""",
        "unique_violations": """SELECT o_custkey::VARCHAR AS wban, count(*) AS count
FROM orders GROUP BY 1 HAVING count(*) > 1""",
        "null_violations": """SELECT 'temperature' AS column_name, count(*) AS violations
FROM events WHERE event_type = 'error' HAVING count(*) > 0""",
        "seconds_between": f"SELECT event_id, {DIFF} AS value FROM events",
        "epoch_seconds": "SELECT event_id, epoch_us(ts) / 1e6 AS value FROM events",
        "lin_interp_scalar": """SELECT event_id, round((user_id - value) / (event_id % 100 + 1.5)::DOUBLE
  * (event_id % 100) + value, 6) AS value FROM events""",
        "lin_interp_ts": f"SELECT event_id, {LINE_TS} AS value FROM events",
        "to_utc": """SELECT event_id, epoch_us(ts) - (user_id % 25 - 12) * 3600000000 AS value FROM events""",
        "parse_datetime": """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click')
  THEN try_strptime(strftime(ts, '%Y%m%d%H%M'), '%Y%m%d%H%M') END AS datetime FROM events""",
        "missing_sentinel": """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value,
  event_type <> 'view' AS valid FROM events""",
        "blank_test": """SELECT doc_id, count(*) AS lines,
  count(*) FILTER (WHERE regexp_full_match(line, '[\\x00-\\x20]*')) AS blank_lines
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
        "read_stations": """SELECT c_custkey::VARCHAR AS wban, c_name AS name, c_mktsegment AS state,
  (c_custkey % 90)::DOUBLE AS latitude, 12 AS ground_height,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN 30 END AS barometer, c_mktsegment <> 'BUILDING' AS ok
FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
        "read_hourly_rejects": """SELECT user_id::VARCHAR AS wban, '20240231' AS date,
  strftime(ts, '%H%M') AS time, event_type AS sky_condition FROM events WHERE event_type = 'signup'""",
        "ingest_csv": INGESTED,
        "ingest_enriched": f"""SELECT user_id::VARCHAR AS wban, c_name AS name, ts::DATE AS date,
  (c_custkey % 90)::DOUBLE AS lat,
  CASE WHEN event_type <> 'error' THEN round(value::FLOAT::DOUBLE, 3) END AS temperature
FROM events JOIN customer ON user_id = c_custkey
WHERE event_type <> 'signup' AND user_id::VARCHAR IN ({FILE_STATIONS})""",
        "ingest_stream": INGESTED,
        "ingest_stream_twice": INGESTED,
        "ingest_stream_renamed": INGESTED,
        "ingest_stream_new_stations": f"""{INGESTED} UNION ALL {INGESTED}
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""",
        "ingest_stream_batches": f"""SELECT (SELECT count(*) FROM ({INGESTED})) AS rows, true AS capped,
  (SELECT count(*) FROM events WHERE event_type <> 'signup') AS records, true AS records_capped""",
        "stream_static_join": f"""SELECT user_id::VARCHAR AS wban, c_name AS name, date_trunc('minute', ts) AS datetime
FROM events JOIN customer ON user_id = c_custkey
WHERE event_type <> 'signup' AND user_id::VARCHAR IN ({FILE_STATIONS})""",
        "write_and_read_weather": """SELECT user_id::VARCHAR AS wban, ts AS datetime,
  CASE WHEN event_type <> 'error' THEN round(value::FLOAT::DOUBLE, 3) END AS temperature,
  NULL::DOUBLE AS windspeed, NULL::DOUBLE AS stationpressure, event_type AS skycondition
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00'""",
        "sql_functions": f"""SELECT event_id, {DIFF} AS diff, epoch_us(ts) / 1e6 AS seconds,
  round((20 - value) / 2 + value, 6) AS line, {LINE_TS} AS line_ts FROM events""",
        "sql_interpolate_one": interpolate_sql(keys=f"SELECT '{ONE}' AS wban"),
        "sql_interpolate_missing_1h": interpolate_sql(WITH_MISSING, keys=f"SELECT '{ONE}' AS wban"),
        "sql_interpolate_missing_1d": interpolate_sql(WITH_MISSING, keys=f"SELECT '{ONE}' AS wban", seconds=86400),
    }
