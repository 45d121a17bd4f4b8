"""Declared schemas. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The columns of the two tables.
STATION = T.StructType(
    [
        T.StructField("station_id", T.IntegerType(), False),
        T.StructField("wban", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("state", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("latitude", T.FloatType(), False),
        T.StructField("longitude", T.FloatType(), False),
        T.StructField("ground_height", T.ShortType()),
        T.StructField("station_height", T.ShortType()),
        T.StructField("timezone", T.ShortType()),
    ]
)

WEATHER_DATA = T.StructType(
    [
        T.StructField("wban", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("temperature", T.FloatType()),
        T.StructField("windspeed", T.FloatType()),
        T.StructField("stationpressure", T.FloatType()),
        T.StructField("skycondition", T.StringType()),
    ]
)

# Fixed values of the station file: 15 cells, named by position.
STATION_FILE_CELLS = [
    "wban",
    "wmo",
    "call_sign",
    "climate_division_code",
    "climate_division_state_code",
    "climate_division_station_code",
    "name",
    "state",
    "location",
    "latitude",
    "longitude",
    "ground_height",
    "station_height",
    "barometer",
    "time_zone",
]

# Fixed values of the hourly file: the positions that carry a mapped cell.
HOURLY_FILE_CELLS = {
    0: "wban",
    1: "date",
    2: "time",
    4: "sky_condition",
    12: "dry_bulb_celsius",
    24: "wind_speed",
    30: "station_pressure",
}


def text_cells(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STATION_FILE = text_cells(STATION_FILE_CELLS)
HOURLY_FILE = text_cells(
    [HOURLY_FILE_CELLS.get(i, f"_skip{i}") for i in range(max(HOURLY_FILE_CELLS) + 1)]
)


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"{f.name} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in schema
    )


def create_tables(spark: SparkSession, database: str = "sample", location: str | None = None) -> None:
    """Create the station and weather tables unless they are there already; a new database is put at ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in (("station", STATION), ("weather_data", WEATHER_DATA)):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns_ddl(schema)}) USING parquet"
        )
