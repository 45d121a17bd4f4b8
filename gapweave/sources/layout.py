"""The weather table laid out so that one station, or one span of time, is found in few files.

Rows are put in the order of a curve (Z-order) of the station's hash and the time, cut into ranges, and sorted by station
and time inside a file. A small versioned table beside them holds the bounds of each file; a reader opens the files whose
bounds meet its stations and times only, and a Bloom filter of the stations in each file lets it skip the row
groups of those that only seem to. A hot station spreads over files by time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.time import as_instant, epoch_micros, ntz_sql
from gapweave.schemas import WEATHER_DATA
from gapweave.sources.sinks import as_weather_rows
from gapweave.sources.versions import VersionedTable

#: bits of the station's hash and of the time in the curve
BITS = 16
# The masks that spread 16 bits over every second one of 32.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("low_hash", T.LongType()),
        T.StructField("high_hash", T.LongType()),
        T.StructField("first", T.TimestampNTZType()),
        T.StructField("last", T.TimestampNTZType()),
    ]
)


def key_hash(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << BITS))


def _spread(bits: Column) -> Column:
    for shift, mask in SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def z_order(a: Column, b: Column) -> Column:
    """The bits of two numbers below 2^16 in turn, those of ``a`` first."""
    return F.shiftleft(_spread(a), 1).bitwiseOR(_spread(b))


def bounds_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path.rstrip('/')}/_files", FILES)


def write_weather_clustered(
    df: DataFrame, path: str, files: int, between: tuple | None = None, row_group_bytes: int | None = None
) -> None:
    """Append weather rows in ``files`` files along the curve, and their bounds.

    ``between`` are the first and last time, if they are known; otherwise the times are read once for them. Rows
    without a station or a time are stored, too; no reader that asks for stations or times finds them.
    """
    spark, rows = df.sparkSession, as_weather_rows(df)
    if between:
        low, high = map(as_instant, between)
    else:
        low, high = rows.agg(F.min(epoch_micros("datetime")), F.max(epoch_micros("datetime"))).first()
    low, high = low or 0, high or 0
    scaled = (epoch_micros("datetime") - F.lit(low)).cast("double") / max(1, high - low) * ((1 << BITS) - 1)
    time = F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), scaled)).cast("long")
    curve = F.coalesce(z_order(key_hash("wban"), time), F.lit(-1).cast("long")).alias("_curve")
    dealt = rows.select("*", curve).repartitionByRange(files, "_curve", "wban", "datetime")
    batch = f"{path.rstrip('/')}/batch={uuid.uuid4().hex}"
    writer = dealt.drop("_curve").sortWithinPartitions("wban", "datetime").write
    writer = writer.option("parquet.bloom.filter.enabled#wban", "true").option("parquet.bloom.filter.expected.ndv#wban", "10000")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(batch)

    stored = spark.read.schema(WEATHER_DATA).parquet(batch).withColumn("path", F.col("_metadata.file_path"))
    bounds = stored.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(key_hash("wban")).alias("low_hash"),
        F.max(key_hash("wban")).alias("high_hash"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
    )
    table = bounds_table(spark, path)
    folder = table.write(bounds)
    while not table.commit(table.latest(), folder):
        pass  # another writer's files came first; these are new to it, too


def read_weather_clustered(
    spark: SparkSession,
    path: str,
    keys: Iterable[str] | None = None,
    start: datetime | date | str | None = None,
    end: datetime | date | str | None = None,
) -> DataFrame:
    """Rows of some stations, or all, from ``start`` to ``end`` (inclusive), out of the files that can hold them."""
    files = bounds_table(spark, path).read()
    keys = None if keys is None else sorted(set(keys))
    if keys is not None:
        asked = spark.createDataFrame([(k,) for k in keys], "wban string").select(key_hash("wban").alias("hash")).distinct()
        files = files.join(asked, F.col("hash").between(F.col("low_hash"), F.col("high_hash")), "left_semi")
    wanted = []
    for bound, sign, column in ((start, ">=", "last"), (end, "<=", "first")):
        if bound is not None:
            limit = ntz_sql(as_instant(bound))
            files = files.where(f"{column} {sign} {limit}")
            wanted.append(f"datetime {sign} {limit}")
    # as many paths as Spark's own listing of the table would hold, at most
    paths = [unquote(r["path"]) for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], WEATHER_DATA)
    rows = spark.read.schema(WEATHER_DATA).parquet(*paths)
    if keys is not None:
        rows = rows.where(F.col("wban").isin(keys))
    for condition in wanted:
        rows = rows.where(condition)
    return rows
