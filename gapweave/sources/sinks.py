"""Writing the weather table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.schemas import WEATHER_DATA

# Fixed value: the size of a bulk insert batch.
BATCH_ROWS = 80_000


def as_weather_rows(df: DataFrame) -> DataFrame:
    """The six columns of the table, in order and with their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_DATA])


def write_weather(
    df: DataFrame,
    path: str,
    mode: str = "append",
    by_day: bool = False,
    max_records_per_file: int | None = None,
    split_by: str | None = None,
    keep: Sequence[str] = (),
) -> None:
    """Append weather rows as Parquet.

    ``split_by`` names a column whose values get a folder each, ``keep`` columns that are stored beside the table's own.

    ``by_day`` partitions the table by the day of the reading. The rebalance hint lets
    Spark gather each day into well-sized files and split a day, or station, that is
    too large for one; sorting inside the files gives row groups narrow bounds.
    """
    folders = [split_by] if split_by else []
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_DATA], *folders, *keep)
    if by_day:
        rows = rows.withColumn("obs_date", F.to_date("datetime"))
        folders.append("obs_date")
    if folders:
        rows = rows.hint("rebalance", *folders)
    writer = rows.sortWithinPartitions(*folders, *keep, "wban", "datetime").write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if folders:
        writer = writer.partitionBy(*folders)
    writer.parquet(path)


def append_stations(rows: DataFrame, path: str) -> None:
    """Append rows of the station table, such as ``upsert_stations`` gives, as Parquet."""
    rows.write.mode("append").parquet(path)


def append_weather_table(df: DataFrame, table: str) -> None:
    """Append weather rows to a catalog table."""
    as_weather_rows(df).write.mode("append").insertInto(table)


def write_weather_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = BATCH_ROWS, **options) -> None:
    """Append weather rows to a database table in batches, one connection per partition."""
    as_weather_rows(df).write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=batch_rows, **options
    ).save()
