"""The ingest pipeline: hourly records to weather rows of known stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.functions.scalar import at_time
from gapweave.operators.stations import (
    dedupe_first,
    enrich_with_station,
    known_stations,
    with_station_struct,
)
from gapweave.sources.files import read_hourly, read_stations


def load_stations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Valid station records, the first one of each station."""
    valid, _ = read_stations(spark, path)
    return dedupe_first(valid, "wban", "file_order").drop("file_order")


def to_observations(hourly: DataFrame, *keep: str) -> DataFrame:
    """Hourly records in the analytic model: station key, date, time of day in seconds, measures; and columns to keep."""
    seconds = F.hour("datetime") * 3600 + F.minute("datetime") * 60
    return hourly.select(
        "wban",
        "date",
        seconds.alias("seconds_of_day"),
        F.col("dry_bulb_celsius").alias("temperature"),
        F.col("wind_speed").alias("windspeed"),
        F.col("station_pressure").alias("stationpressure"),
        F.col("sky_condition").alias("skycondition"),
        *keep,
    )


def with_station(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Observations of known stations with the nested ``station``. One record per station."""
    return enrich_with_station(observations, with_station_struct(stations), unique=True)


def to_weather_rows(observations: DataFrame, *keep: str) -> DataFrame:
    """Flatten to the rows of the weather table; date and time become one timestamp. And columns to keep."""
    key = "station.wban" if "station" in observations.columns else "wban"
    return observations.select(
        F.col(key).alias("wban"),
        at_time("date", "seconds_of_day").alias("datetime"),
        *("temperature", "windspeed", "stationpressure", "skycondition"),
        *keep,
    )


def weather_rows(hourly: DataFrame, stations: DataFrame, *keep: str, unique: bool = False) -> DataFrame:
    """Valid hourly records to weather rows. The table needs no station column, so a semi join will do."""
    return to_weather_rows(known_stations(to_observations(hourly, *keep), stations, unique=unique), *keep)


def ingest(spark: SparkSession, hourly_path: str | list[str], station_path: str | list[str]) -> DataFrame:
    """Weather rows of hourly files for the stations of station files."""
    hourly, _ = read_hourly(spark, hourly_path)
    return weather_rows(hourly, load_stations(spark, station_path))
