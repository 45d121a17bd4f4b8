"""Filled summaries of a growing table, kept up to date batch by batch.

A batch is aggregated to one row per series and slice, its "states", which are added to those of earlier batches: counts,
extremes, sums, the first and last known reading. Parts of one slice are merged when they are read. The first and last known
reading of each series in each block of slices is kept too, the "borders". What a batch changes are

* the blocks that it has readings for, and
* of the same series, the blocks up to the next one with a known reading on either side, as their empty slices lie on a line to an
  anchor that may have moved; without such a block, all up to the end of the range.

Only those are made again, from their own states and the nearest borders, and their rows replace the older ones. Nothing
of other series is read, and of other blocks nothing but the borders.

What is stored of a block are its "lines": a row for each state and for the start of the block, with the state's own aggregates and
the line of the empty slices up to the next one. They unfold when they are read, so empty slices are neither written nor
compared by version. States never go away, so each older line has a newer one that begins at the same slice.

Readings without a value that lie between known ones of their slice need these one by one. So the readings
are kept as well, by block, and read for slices where that happens, as in a full run.

Late readings are like any others. A batch that is added twice counts twice, like rows of a table that are there twice.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.time import from_micros_sql, quoted
from gapweave.operators.fill import (
    SUMMARY,
    Fill,
    fill_options,
    merged_states,
    reading_states,
    tie_break_sql,
    with_inner_readings,
    with_neighbours,
)
from gapweave.operators.resample import DEFAULT_AGGS, NAMED, Aggregates, summary_lines, unfolded_summaries
from gapweave.operators.slices import unfold_partitions
from gapweave.session import scratch_path
from gapweave.sources.versions import Version, VersionedTable

STATE_COLUMNS = {
    "readings": "bigint", "observed": "bigint", "lo": "double", "hi": "double", "total": "double",
    "kf": "bigint", "kl": "bigint", "null_lo": "bigint", "null_hi": "bigint", "yf": "double", "yl": "double",
}
TYPES = {"string": T.StringType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType()}
#: partition of rows that are read for all blocks
EVERYWHERE = -1
#: slices in a block: a month by the hour
BLOCK = 720
#: top bits of a hash order the values of one instant, as in a slice
TIE_BITS = 62


class ResampleState:
    """The summaries that ``interpolate_series`` gives, of all readings added so far.

    ``path`` holds the state; another object with the same choices goes on with it. The series are those that have a reading in the range;
    their keys are given as strings. Rows that newer ones replace stay in the table's files.
    Readings without a value take part as with ``anchors="paired"``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        start: datetime | date | str,
        end: datetime | date | str,
        step: timedelta,
        *,
        key: str = "wban",
        ts: str = "datetime",
        value: str = "temperature",
        aggs: Aggregates = DEFAULT_AGGS,
        method: str = "linear",
        rounding: str = "reference",
        on_degenerate: str = "error",
        block_slices: int = BLOCK,
    ):
        if not all(isinstance(how, str) and how in NAMED for how in aggs.values()):
            raise ValueError(f"aggregates are names of {sorted(NAMED)}")
        self.spark, self.aggs = spark, aggs
        self.fill: Fill = fill_options(
            start, end, step, True, block_slices,
            key=key, ts=ts, value=value, rounding=rounding, method=method, on_degenerate=on_degenerate,
        )
        self.slices = self.fill.slices
        self.block = self.slices.block_of_sql("slice_us")
        self.choices = {
            "range": [self.slices.start_us, self.slices.end_us, self.slices.step_us, block_slices],
            "how": [method, rounding, on_degenerate, list(aggs.values())],
            "rows": "lines",  # a table that holds slices is from before there were lines
        }
        line = {"next_us": "bigint", "occupied": "boolean", "y0": "double"}
        line |= {"x0": "double", "slope": "double"} if method == "linear" else {}
        self.line = line | {f"own_{how}": "bigint" if how == "count" else "double" for how in aggs.values()}
        columns = {"key": "string", "slice_us": "bigint", "us": "bigint", "v": "double", **STATE_COLUMNS, **self.line}
        columns |= {"version": "bigint", "kind": "string", "part": "bigint"}
        self.schema = T.StructType([T.StructField(n, TYPES[t]) for n, t in columns.items()])
        self.table = VersionedTable(spark, path, self.schema, ("kind", "part"))

    def _rows(self, df: DataFrame, kind: str, part: str) -> DataFrame:
        """``df`` in the columns of the table, NULL where it has none."""
        own = {f.name: f.dataType.simpleString() for f in self.schema}
        given = {"kind": f"'{kind}'", "part": part}
        return df.selectExpr(
            *[
                f"CAST({given.get(n) or (quoted(n) if n in df.columns else 'NULL')} AS {t}) AS {quoted(n)}"
                for n, t in own.items()
            ]
        )

    def _known(self, borders: DataFrame) -> DataFrame:
        """One row per series and block with readings: the first and last known one, NULL if none is known."""
        first, last = (tie_break_sql(y, TIE_BITS) for y in ("yf", "yl"))  # of several values at one instant
        return borders.groupBy("key", F.expr(self.block).alias("block")).agg(
            F.expr("min(kf) AS kf"),
            F.expr("max(kl) AS kl"),
            F.expr(f"min_by(yf, CASE WHEN kf IS NOT NULL THEN struct(kf, -{first}) END) AS yf"),
            F.expr(f"max_by(yl, CASE WHEN kl IS NOT NULL THEN struct(kl, {last}) END) AS yl"),
        )

    def _affected(self, touched: DataFrame, known: DataFrame) -> DataFrame:
        """(key, first, last): ranges of blocks to be unfolded again, one for each touched block of a series."""
        anchors = known.where("kf IS NOT NULL").select("key", "block", F.lit(True).alias("anchor"))
        marks = touched.join(anchors, ["key", "block"], "full_outer").select(
            "key", "block", "touched", F.when(F.col("anchor"), F.col("block")).alias("at")
        )
        before = "OVER (PARTITION BY key ORDER BY block ASC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        after = "OVER (PARTITION BY key ORDER BY block DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return (
            marks.selectExpr(
                *("key", "touched"),
                f"coalesce(last(at, true) {before}, 0L) AS first",
                f"coalesce(last(at, true) {after}, {self.slices.blocks - 1}L) AS last",
            )
            .where("touched")
            .drop("touched")
        )

    def _lines(self, base: Version, states: DataFrame, borders: DataFrame, readings: DataFrame, folder: str) -> DataFrame:
        """Lines of the blocks that a batch changes, its parts included in the arguments' batch rows."""
        old = self.table.read(base)
        touched = states.select("key", F.expr(self.block).alias("block")).distinct().withColumn("touched", F.lit(True))
        series = touched.select("key").distinct()
        state_columns = ("key", "slice_us", *STATE_COLUMNS)
        all_borders = old.where("kind = 'border'").select(*state_columns).join(series, "key", "left_semi")
        known = self._known(all_borders.unionByName(borders))
        blocks = (
            self._affected(touched, known)
            .selectExpr("key", "explode(sequence(first, last)) AS block")
            .distinct()
        )
        path = f"{folder}/blocks"
        blocks.write.parquet(path)
        blocks = self.spark.read.parquet(path)
        # numbers of blocks, as many as the range has at most
        parts = [r[0] for r in blocks.select("block").distinct().collect()]

        def stored(kind: str, *columns: str) -> DataFrame:
            rows = old.where((F.col("kind") == kind) & F.col("part").isin(parts))
            rows = rows.withColumnRenamed("part", "block").join(blocks, ["key", "block"], "left_semi")
            return rows.select("key", "slice_us", *columns)

        own = stored("state", *STATE_COLUMNS).unionByName(states)
        # a row at the start of each block, so that empty slices unfold in their own block
        starts = blocks.selectExpr("key", f"block * {self.slices.block_us}L + {self.slices.start_us}L AS slice_us")
        own = own.unionByName(starts.selectExpr("*", "0L AS readings", "0L AS observed"), allowMissingColumns=True)
        merged = merged_states(own.withColumnRenamed("key", "_key"), self.fill)
        rows = stored("reading", "us", "v").unionByName(readings).withColumnRenamed("key", "_key")
        inner = with_inner_readings(merged, rows, self.fill)
        # anchors of other blocks: states without readings of their own, as far as the unfolding goes
        outside = known.where("kf IS NOT NULL").join(blocks, ["key", "block"], "left_anti")
        outside = outside.selectExpr(
            "key AS _key",
            f"block * {self.slices.block_us}L + {self.slices.start_us}L AS slice_us",
            *("0L AS readings", "0L AS observed", "kf", "kl", "yf", "yl", "0L AS known", "0L AS lead_n", "0L AS trail_n"),
        )
        every = inner.unionByName(outside, allowMissingColumns=True)
        every = with_neighbours(every, self.fill, SUMMARY)
        chosen = blocks.selectExpr("key AS _key", "block AS _block")
        every = every.withColumn("_block", F.expr(self.block)).join(chosen, ["_key", "_block"], "left_semi")
        return summary_lines(every.drop("_block"), self.fill, self.aggs).withColumnRenamed("_key", "key")

    def _latest(self) -> Version:
        base = self.table.latest()
        if base.properties and base.properties != self.choices:
            raise ValueError(f"{self.table.path} was made with other choices: {base.properties}")
        return base

    def add(self, batch: DataFrame, attempts: int = 20) -> DataFrame:
        """Take a batch of readings; returns the rows that it changed or made, as ``result`` gives them."""
        folder = scratch_path(self.spark, "resample")
        f = self.fill
        f.in_range(batch).selectExpr("CAST(_key AS STRING) AS key", "slice_us", "us", "v").write.parquet(f"{folder}/readings")
        readings = self.spark.read.parquet(f"{folder}/readings")
        states = reading_states(readings.withColumnRenamed("key", "_key"), f).withColumnRenamed("_key", "key")
        states.write.parquet(f"{folder}/states")
        states = self.spark.read.parquet(f"{folder}/states").select("key", "slice_us", *STATE_COLUMNS)
        borders = self._known(states).selectExpr(
            "key", f"block * {self.slices.block_us}L + {self.slices.start_us}L AS slice_us", "kf", "kl", "yf", "yl"
        )
        nothing = [F.lit(None).cast(t).alias(n) for n, t in STATE_COLUMNS.items() if n not in ("kf", "kl", "yf", "yl")]
        borders = borders.select("*", *nothing).select("key", "slice_us", *STATE_COLUMNS)
        for attempt in range(attempts):
            base = self._latest()
            new = self._lines(base, states, borders, readings, f"{folder}/{attempt}")
            new = new.withColumn("version", F.lit(base.number + 1))
            rows = self._rows(states, "state", self.block).unionAll(self._rows(borders, "border", str(EVERYWHERE)))
            rows = rows.unionAll(self._rows(readings, "reading", self.block)).unionAll(self._rows(new, "line", self.block))
            made = self.table.write(rows)
            changed = self.table.written(made).where("kind = 'line'")
            if self.table.commit(base, made, **self.choices):
                return self._shown(changed.repartition(unfold_partitions(changed), "key", "slice_us"))
            self.table.files.delete(made)
        raise RuntimeError(f"{attempts} attempts to write {self.table.path} met another writer's commit")

    def _shown(self, stored: DataFrame) -> DataFrame:
        slices = unfolded_summaries(stored.withColumnRenamed("key", "_key"), self.fill, self.aggs)
        return slices.selectExpr(
            f"_key AS {quoted('r_' + self.fill.key)}",
            f"{from_micros_sql('slot_us')} AS r_slice",
            *map(quoted, self.aggs),
        )

    def result(self) -> DataFrame:
        """One row per series and slice, as ``interpolate_series`` gives them with ``keys="range"``."""
        rows = self.table.read(self._latest()).where("kind = 'line'")
        newest = F.max_by(F.struct(*self.line), "version").alias("_new")
        rows = rows.repartition(unfold_partitions(rows), "key", "slice_us")  # they unfold to more than their size shows
        return self._shown(rows.groupBy("key", "slice_us").agg(newest).select("key", "slice_us", "_new.*"))
