"""Reading the delimited station and hourly files, and the weather table.

Every cell is read as text and converted by column expressions, so that a malformed
cell marks its own row instead of failing the job. Cells go by position; the header
is only skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.scalar import cell_is_valid, is_blank, parse_datetime, parse_missing, trim_cell
from gapweave.functions.time import as_instant, ntz_sql
from gapweave.schemas import HOURLY_FILE, HOURLY_FILE_CELLS, STATION_FILE, WEATHER_DATA

# Fixed value: the marker of a missing number in the hourly file.
MISSING = "M"

HOURLY_NUMBERS = ("dry_bulb_celsius", "wind_speed", "station_pressure")
STATION_NUMBERS = {
    "latitude": "float",
    "longitude": "float",
    "ground_height": "int",
    "station_height": "int",
    "barometer": "int",
    "time_zone": "int",
}
STATION_OPTIONAL = ("ground_height", "station_height", "barometer")


def delimited(reader, schema: T.StructType, separator: str):
    """Configure a batch or streaming reader for one of the files.

    Quotes are ordinary characters. Cells beyond the declared ones are not parsed.
    """
    return (
        reader.schema(schema)
        .option("sep", separator)
        .option("header", True)
        .option("quote", "")
        .option("encoding", "US-ASCII")
        .option("mode", "PERMISSIVE")
        .format("csv")
    )


def text_cell(name: str) -> Column:
    """A text cell as it stands, trimmed. Spark reads an empty cell as NULL."""
    return F.coalesce(trim_cell(name), F.lit(""))


def hourly_cells(raw: DataFrame, *others: Column) -> DataFrame:
    """The mapped cells of the hourly file, right after the scan so that it prunes the rest."""
    return raw.select(*HOURLY_FILE_CELLS.values(), *others)


def parse_hourly(cells: DataFrame, day_overflow: str = "reject", keep: Sequence[str] = ()) -> DataFrame:
    """Typed hourly records plus ``is_valid`` and columns to keep. Works on batch and streaming input.

    A row that is too short has no last cell, and that cell must be a number or the
    missing marker, so short rows are invalid like any malformed cell.
    """
    at = parse_datetime("date", "time", day_overflow)
    valid = at.isNotNull()
    for name in HOURLY_NUMBERS:
        valid = valid & cell_is_valid(name, "float", (MISSING,))
    return cells.select(
        text_cell("wban").alias("wban"),
        at.cast("date").alias("date"),
        at.alias("datetime"),
        text_cell("sky_condition").alias("sky_condition"),
        *[parse_missing(c, "float", (MISSING,)).alias(c) for c in HOURLY_NUMBERS],
        valid.alias("is_valid"),
        F.struct(*[c for c in cells.columns if c not in keep]).alias("cells"),
        *keep,
    )


def parse_stations(cells: DataFrame) -> DataFrame:
    """Typed station records plus ``is_valid``; blank heights and barometers are NULL."""
    valid = F.lit(True)
    for name, kind in STATION_NUMBERS.items():
        ok = cell_is_valid(name, kind)
        valid = valid & (ok | is_blank(name) if name in STATION_OPTIONAL else ok)
    return cells.select(
        *[
            (parse_missing(c, STATION_NUMBERS[c]) if c in STATION_NUMBERS else text_cell(c)).alias(c)
            for c in STATION_FILE.names
        ],
        valid.alias("is_valid"),
        F.struct(*STATION_FILE.names).alias("cells"),
        *[c for c in cells.columns if c not in STATION_FILE.names],
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, the text cells of the rejected ones)."""
    valid = parsed.where("is_valid").drop("is_valid", "cells")
    return valid, parsed.where("NOT is_valid").select("cells.*")


def read_hourly(
    spark: SparkSession, path: str | list[str], day_overflow: str = "reject"
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) records of hourly files."""
    raw = delimited(spark.read, HOURLY_FILE, ",").load(path)
    return split_valid(parse_hourly(hourly_cells(raw), day_overflow))


def read_stations(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) records of station files.

    The valid ones carry ``file_order``, which orders records as they stand in the
    files (file by file in name order), for keeping the first record of a station.
    """
    raw = delimited(spark.read, STATION_FILE, "|").load(path)
    position = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    return split_valid(parse_stations(raw.select(*STATION_FILE.names, position.alias("file_order"))))


def read_weather(
    spark: SparkSession,
    path: str,
    start: datetime | date | str | None = None,
    end: datetime | date | str | None = None,
) -> DataFrame:
    """The weather table, optionally only from ``start`` to ``end`` (inclusive).

    The table's own six columns, however it is laid out. The bounds reach the file scan; on
    a table partitioned by day they also drop whole partitions.
    """
    table = spark.read.parquet(path)
    for bound, sign in ((start, ">="), (end, "<=")):
        if bound is not None:
            limit = ntz_sql(as_instant(bound))
            table = table.where(f"datetime {sign} {limit}")
            if "obs_date" in table.columns:
                table = table.where(f"obs_date {sign} CAST({limit} AS DATE)")
    return table.select(*WEATHER_DATA.names)
