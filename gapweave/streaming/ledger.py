"""Which files have been taken into a weather table, whatever folder they were asked for by.

The ledger is a versioned table beside the target: per micro-batch, the files that it took, by their full path, and
which of their records went into which split. A micro-batch claims its files before it writes rows: it commits
those that nobody has claimed, so of two streams that meet a file at the same time one gets it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.sources.versions import Version, VersionedTable

#: columns that a stream of files carries for the ledger
FILE_COLUMNS = ["_path", "_bytes", "_modified", "_block"]

#: so many files are looked up by their names, which Parquet's bounds tell apart, more by a join
LISTED = 1_000

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("split", T.LongType()),
        T.StructField("first_record", T.LongType()),
        T.StructField("records", T.LongType()),
    ]
)


def file_columns() -> list:
    """The file that each row was read from, and where the part of it that a task read begins."""
    names = ("file_path", "file_size", "file_modification_time", "file_block_start")
    return [F.col(f"_metadata.{n}").alias(c) for n, c in zip(names, FILE_COLUMNS, strict=True)]


class TakenFiles:
    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self.table = VersionedTable(spark, f"{target.rstrip('/')}/_ledger", LEDGER)

    def read(self) -> DataFrame:
        """One row per file and split: its first record in the file, counted from 0, and how many."""
        return self.table.read()

    def _small(self, rows: list[dict], columns: str) -> DataFrame:
        """Rows known here as a table that Spark knows to be small; it runs no Python for them."""
        return self.spark.sql(f"SELECT inline(from_json(:rows, 'array<struct<{columns}>>'))", {"rows": json.dumps(rows)})

    def _met(self, base: Version, paths: list[str], query: str, batch: int) -> dict[str, tuple[bool, int]]:
        """Of files that are in the ledger: whether this batch took them, and how long they were."""
        known = self.table.read(base)
        if len(paths) <= LISTED:
            known = known.where(F.col("path").isin(paths))
        else:
            known = known.join(self._small([{"path": p} for p in paths], "path string"), "path", "left_semi")
        mine = (F.col("query") == query) & (F.col("batch") == batch)
        met = known.groupBy("path").agg(F.bool_or(mine).alias("mine"), F.max("bytes").alias("bytes"))
        return {r["path"]: (r["mine"], r["bytes"]) for r in met.collect()}

    def claim(self, pieces: DataFrame, query: str, batch: int, cap: int) -> DataFrame:
        """The pieces of files that this micro-batch takes, with ``start``, their first record's number in it.

        ``pieces`` has the file columns, any others, and ``records``: a row for each part that Spark read a file in. They are
        numbered where Spark keeps the list of the batch's files, on the driver; records never come there. Records are numbered
        file by file, so that splits of ``cap`` records don't depend on how Spark read the files. A batch that
        is run again gets what it had claimed.
        """
        pieces = pieces.withColumn("_modified", F.unix_micros("_modified"))  # a Python datetime would go through a zone
        found = sorted((r.asDict() for r in pieces.collect()), key=lambda r: (r["_path"], r["_block"]))
        paths = list(dict.fromkeys(r["_path"] for r in found))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", start bigint"
        while True:
            base = self.table.latest()
            met = self._met(base, paths, query, batch) if paths and base.parts else {}
            numbered, fresh, start = [], {}, 0
            for piece in found:
                path, records = piece["_path"], piece["records"]
                mine, size = met.get(path, (None, piece["_bytes"]))
                if size != piece["_bytes"]:
                    raise ValueError(f"file has changed since it was taken: {path}")
                if mine is False:
                    continue
                if mine is None:
                    taken = {"path": path, "bytes": size, "modified": piece["_modified"], "start": start, "n": 0}
                    fresh.setdefault(path, taken)["n"] += records
                numbered.append({**piece, "start": start})
                start += records
            claimed = self._small(numbered, columns).withColumn("_modified", F.timestamp_micros("_modified"))
            if not fresh:
                return claimed
            folder = self.table.write(self._entries(list(fresh.values()), query, batch, cap))
            if self.table.commit(base, folder):
                return claimed
            self.table.files.delete(folder)

    def _entries(self, files: list[dict], query: str, batch: int, cap: int) -> DataFrame:
        """Rows of the ledger for files with the number of their first record in the batch and how many they have."""
        taken = self._small(files, "path string, bytes bigint, modified bigint, start bigint, n bigint")
        splits = taken.where("n > 0").selectExpr(
            "*", f"explode(sequence(start div {cap}L, (start + n - 1) div {cap}L)) AS split"
        )
        return splits.select(
            "path", "bytes", F.timestamp_micros("modified").alias("modified"),
            F.lit(query).alias("query"), F.lit(batch).cast("long").alias("batch"), "split",
            F.expr(f"greatest(start, split * {cap}L) - start AS first_record"),
            F.expr(f"least(start + n, (split + 1) * {cap}L) - greatest(start, split * {cap}L) AS records"),
        )
