"""The supplied tables in the roles of the station, weather and file inputs.

``events`` are the readings of a user, ``customer`` the stations. A reading without a
value is an event of type 'error'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.schemas import HOURLY_FILE, STATION_FILE
from gapweave.session import scratch_path


#: rows of an hourly file, and files of a table that would make fewer
FILE_ROWS, FEW_FILES = 500_000, 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def weather(spark: SparkSession, folder: str, with_missing: bool = False) -> DataFrame:
    value = F.col("value")
    if with_missing:
        value = F.when(F.col("event_type") != "error", value)
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("wban"),
        F.col("ts").alias("datetime"),
        value.alias("temperature"),
        F.col("event_type").alias("skycondition"),
    )


def stations(spark: SparkSession, folder: str, segment: str | None = None) -> DataFrame:
    customers = table(spark, folder, "customer")
    if segment:
        customers = customers.where(F.col("c_mktsegment") == segment)
    return customers.select(
        F.col("c_custkey").cast("string").alias("wban"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("state"),
        F.lit(None).cast("string").alias("location"),
        (F.col("c_custkey") % 90).cast("float").alias("latitude"),
        (F.col("c_custkey") % 180).cast("float").alias("longitude"),
        F.col("c_nationkey").cast("int").alias("time_zone"),
    )


def date_cell(ts: str):
    return F.replace(F.substring(F.col(ts).cast("string"), 1, 10), F.lit("-"), F.lit(""))


def time_cell(ts: str):
    return F.replace(F.substring(F.col(ts).cast("string"), 12, 5), F.lit(":"), F.lit(""))


def write_hourly_files(spark: SparkSession, folder: str) -> str:
    """The events as hourly files: 'error' has the missing marker, 'signup' a date that is none.

    Files have about ``FILE_ROWS`` rows, some 50 MB, whatever the size of the cluster; of fewer rows there are a few files.
    """
    kind = F.col("skycondition")
    cells = {
        "wban": F.col("wban"),
        "date": F.when(kind == "signup", F.lit("20240231")).otherwise(date_cell("datetime")),
        "time": time_cell("datetime"),
        "sky_condition": kind,
        "dry_bulb_celsius": F.when(kind == "error", F.lit("M")).otherwise(F.col("temperature").cast("string")),
        "wind_speed": F.concat(F.lit(" "), (F.col("event_id") % 40).cast("string")),
        "station_pressure": F.when(kind == "view", F.lit("M")).otherwise(F.lit("29.92")),
    }
    path = scratch_path(spark, "hourly")
    rows = weather(spark, folder)
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), FEW_FILES)
    rows = rows.repartition(max(few, -(-rows.count() // FILE_ROWS)), "event_id")
    rows.select(
        *[cells.get(n, F.lit(None).cast("string")).alias(n) for n in HOURLY_FILE.names]
    ).write.option("header", True).csv(path)
    return path


def write_station_files(spark: SparkSession, folder: str) -> str:
    """The customers as station files, but for those in FURNITURE.

    Those in MACHINERY have no barometer, those in BUILDING a bad time zone.
    """
    rows = stations(spark, folder).where(F.col("state") != "FURNITURE")
    cells = {
        "wban": F.col("wban"),
        "name": F.col("name"),
        "state": F.col("state"),
        "latitude": F.col("latitude").cast("string"),
        "longitude": F.col("longitude").cast("string"),
        "ground_height": F.lit("12"),
        "barometer": F.when(F.col("state") != "MACHINERY", F.lit("30")),
        "time_zone": F.when(F.col("state") == "BUILDING", F.lit("east")).otherwise(
            F.col("time_zone").cast("string")
        ),
    }
    path = scratch_path(spark, "stations")
    rows.select(
        *[cells.get(n, F.lit(None).cast("string")).alias(n) for n in STATION_FILE.names]
    ).write.option("header", True).option("sep", "|").csv(path)
    return path
