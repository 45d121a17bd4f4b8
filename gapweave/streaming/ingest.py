"""Continuous ingest of hourly files with Structured Streaming."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gapweave.plans.ingest import weather_rows
from gapweave.schemas import HOURLY_FILE
from gapweave.session import kept
from gapweave.sources.files import delimited, hourly_cells, parse_hourly
from gapweave.sources.sinks import BATCH_ROWS, write_weather
from gapweave.sources.station_table import StationTable
from gapweave.sources.versions import Files, canonical
from gapweave.streaming.ledger import FILE_COLUMNS, TakenFiles, file_columns


def hourly_stream(
    spark: SparkSession, folder: str, max_files: int | None = None, with_files: bool = False
) -> DataFrame:
    """Valid hourly records of the files that arrive in a folder, if asked with the file they come from."""
    reader = delimited(spark.readStream, HOURLY_FILE, ",")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = file_columns() if with_files else []
    parsed = parse_hourly(hourly_cells(reader.load(folder), *files), keep=FILE_COLUMNS if with_files else ())
    return parsed.where("is_valid").drop("is_valid", "cells")


def _staged_pieces(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records of a staged batch, and one row for each part of a file in each staged file."""
    places = [F.col("_metadata.file_path").alias("_part"), F.col("_metadata.row_index").alias("_place")]
    staged = spark.read.schema(schema).parquet(path).select("*", *places)
    pieces = staged.groupBy(*FILE_COLUMNS, "_part").agg(
        F.min("_place").alias("first_place"), F.count(F.lit(1)).alias("records")
    )
    return staged, pieces


def stream_ingest(
    spark: SparkSession,
    folder: str,
    stations: DataFrame | StationTable,
    target: str,
    checkpoint: str | None = None,
    every: str | None = "2 seconds",
    max_files: int | None = None,
    max_records_per_file: int = BATCH_ROWS,
    by_day: bool = False,
    batch_rows: int = BATCH_ROWS,
) -> StreamingQuery:
    """Append the weather rows of arriving files to ``target``; returns the running query.

    Stations in a DataFrame are read once, at the start. Of a ``StationTable``, each micro-batch joins the latest version,
    so that stations are seen as they come, and keeps its number beside the target, so that it joins the same
    one when it is run again. The join is that of an ordinary batch query: Spark measures sizes and splits
    a hot station. Neither has a key twice, so no micro-batch combines them again.

    Each file is taken once: a ledger beside the target knows the files by their full paths (see ``ledger``), so a folder
    may be named in any way, by a pattern or through a folder above, and by several streams at once. A
    file that has another size than when it was taken fails the query.

    A micro-batch stages its records, claims the files that are new, and appends their rows in batches of at most
    ``batch_rows`` records, all in one job; batch k of them are the rows with ``split = k`` in the folder
    ``query=<id>/batch=<number>`` under the target. The split is a column, as a folder for each would make small files of
    small batches; a table that has such folders gets more of them. Records are numbered file by file, so
    what goes into which split doesn't depend on the run; the ledger tells which records of a file they are. A micro-batch
    that is run again after a failure gets its own files again and replaces its own folder only.

    What a stream has read is remembered beside the target, too, so calling this again goes on where the last call
    ended, with whatever ``max_files``. A ``checkpoint`` of one's own must be there already if the target
    holds rows: a fresh one would take files again that were stored before there was a ledger. ``by_day`` lays each
    batch out by day, for readers that ask for a range of time; it is the same for all calls on a target.
    ``every=None`` takes what is there and ends.
    """
    files = Files(spark, target)
    if checkpoint and not Files(spark, checkpoint).names("metadata") and files.matches("query=*"):
        raise ValueError(f"{target} holds rows that checkpoint {checkpoint} doesn't know of")
    folder = canonical(spark, folder)
    of_folder = hashlib.sha256(folder.encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{target}/_checkpoint/{of_folder}"
    known = None if isinstance(stations, StationTable) else kept(stations.select("wban").distinct(), "known")
    ledger = TakenFiles(spark, target)
    folders = bool(files.matches("query=*/batch=*/split=*"))  # of a table from before the split was a column

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        identity = json.loads(Files(spark, checkpoint).text("metadata"))["id"]
        own, stage = f"query={identity}/batch={number}", f"_staging/{identity}-{number}"
        batch.write.mode("overwrite").parquet(f"{target}/{stage}")
        staged, pieces = _staged_pieces(session, f"{target}/{stage}", batch.schema)
        claimed = ledger.claim(pieces, identity, number, batch_rows)
        records = staged.join(claimed.select("_part", "_path", "_block", "start", "first_place"), ["_part", "_path", "_block"])
        split = F.expr(f"(start + _place - first_place) div {batch_rows}L").alias("split")
        there = known if known is not None else stations.of_batch(files, f"_stations/{own}.json").select("wban")
        rows = weather_rows(records.select(*batch.columns, split), there, "split", unique=True)
        layout = {"by_day": by_day, "max_records_per_file": max_records_per_file}
        layout |= {"split_by": "split"} if folders else {"keep": ["split"]}
        write_weather(rows, f"{target}/{own}", mode="overwrite", **layout)
        files.delete(stage)

    rows = hourly_stream(spark, folder, max_files, with_files=True)
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
