"""Gaps of a growing table, kept up to date batch by batch without reading the history again.

What ``find_gaps`` needs of a series is the first and last instant of each bucket of threshold + 1 microsecond. These are kept,
by blocks of ``fan`` buckets, and so are the first and last instant of each series in each block. A batch is
aggregated to buckets; only the blocks that it touches are read, and of the other blocks the first and last
instants of the series that it touches. Gaps inside those blocks and between blocks are compared before and after: what
appears and what goes away are the changes of the batch. Late readings are like any others.

All of it is one versioned table, to which a batch adds its own rows only: first and last instants are combined
when they are read, so a batch may be added again without harm.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.time import epoch_micros, floor_to, from_micros
from gapweave.session import require_ntz, scratch_path
from gapweave.sources.versions import Version, VersionedTable

DAY_US = 86_400_000_000
#: partition of rows that belong to no block
EVERYWHERE = -1

STATE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("change", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("part", T.LongType()),
    ]
)


def _combined(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


class GapState:
    def __init__(
        self, spark: SparkSession, path: str, threshold_s: float = 3600, fan: int | None = None,
        key: str = "wban", ts: str = "datetime",
    ):
        if threshold_s < 0:
            raise ValueError("threshold_s must not be negative")
        self.spark, self.key, self.ts = spark, key, ts
        self.longest = math.floor(round(threshold_s * 1_000_000, 3))
        self.width = self.longest + 1
        #: about a day, and never less than a few buckets
        self.block_us = self.width * (fan or max(8, DAY_US // self.width))
        self.table = VersionedTable(spark, path, STATE, ("kind", "part"))

    def _buckets(self, batch: DataFrame) -> DataFrame:
        require_ntz(batch, self.ts)
        rows = batch.where(F.col(self.ts).isNotNull()).select(
            F.col(self.key).cast("string").alias("key"), epoch_micros(self.ts).alias("us")
        )
        buckets = rows.groupBy("key", floor_to(F.col("us"), self.width).alias("bucket")).agg(
            F.min("us").alias("lo"), F.max("us").alias("hi")
        )
        return buckets.select("key", floor_to(F.col("bucket"), self.block_us).alias("block"), "lo", "hi")

    def _pairs(self, rows: DataFrame, *group: str) -> DataFrame:
        """(key, lo, hi): the instants on both sides of the gaps between neighbouring rows of a group."""
        before = F.lag("hi").over(Window.partitionBy(*group).orderBy("lo"))
        pairs = rows.select("key", F.col("lo").alias("hi"), before.alias("lo"))
        return pairs.where(F.col("hi") - F.col("lo") > self.longest).select("key", "lo", "hi")

    def _gaps(self, buckets: DataFrame, borders: DataFrame) -> DataFrame:
        """Gaps inside blocks and between blocks."""
        by_bucket = buckets.withColumn("bucket", floor_to(F.col("lo"), self.width))
        inside = self._pairs(_combined(by_bucket, "key", "block", "bucket"), "key", "block")
        return inside.unionAll(self._pairs(_combined(borders, "key", "block"), "key"))

    def _changes(self, base: Version, new: DataFrame) -> DataFrame:
        state = self.table.read(base)
        # the blocks of a batch, not its series: as many as the days it covers
        blocks = [r[0] for r in new.select("block").distinct().collect()]
        touched = new.select(F.col("key").alias("_key")).distinct()
        own = F.col("key").eqNullSafe(F.col("_key"))
        columns = ("key", "block", "lo", "hi")
        old = state.where((F.col("kind") == "bucket") & F.col("part").isin(blocks)).select(*columns)
        old = old.join(touched, own, "left_semi")
        borders = state.where("kind = 'border'").select(*columns).join(touched, own, "left_semi")
        before = self._gaps(old, borders)
        after = self._gaps(old.unionAll(new), borders.unionAll(_combined(new, "key", "block").select(*columns)))
        found = after.exceptAll(before).withColumn("change", F.lit(1))
        return found.unionAll(before.exceptAll(after).withColumn("change", F.lit(-1)))

    def add(self, batch: DataFrame, attempts: int = 20) -> DataFrame:
        """Take a batch of readings; returns its changes: key, current_datetime, previous_datetime and change, 1 or -1."""
        path = scratch_path(self.spark, "buckets")
        self._buckets(batch).write.parquet(path)
        new = self.spark.read.parquet(path)
        nothing = F.lit(None).cast("int").alias("change")
        here, nowhere = F.col("block").alias("part"), F.lit(EVERYWHERE).cast("long").alias("part")
        columns = ("key", "block", "lo", "hi")
        for _ in range(attempts):
            base = self.table.latest()
            rows = new.select(*columns, nothing, F.lit("bucket").alias("kind"), here)
            rows = rows.unionAll(_combined(new, "key", "block").select(*columns, nothing, F.lit("border"), nowhere))
            changes = self._changes(base, new).select(
                "key", F.lit(None).cast("long"), "lo", "hi", "change", F.lit("change"), nowhere
            )
            folder = self.table.write(rows.unionAll(changes))
            if self.table.commit(base, folder):
                return self._shown(self.table.written(folder).where("kind = 'change'"))
            self.table.files.delete(folder)
        raise RuntimeError(f"{attempts} attempts to write {self.table.path} met another writer's commit")

    def _shown(self, changes: DataFrame) -> DataFrame:
        return changes.select(
            F.col("key").alias(self.key),
            from_micros("hi").alias("current_datetime"),
            from_micros("lo").alias("previous_datetime"),
            "change",
        )

    def gaps(self) -> DataFrame:
        """The gaps of all readings that were added, as ``find_gaps`` gives them."""
        shown = self._shown(self.table.read().where("kind = 'change'"))
        rows = shown.groupBy(self.key, "current_datetime", "previous_datetime").agg(F.sum("change").alias("change"))
        return rows.where("change > 0").drop("change")
