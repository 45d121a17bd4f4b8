"""Where each row stands in the order of its group, without one task per group.

Rows are dealt out by ranges of (group, order), numbered inside their range in one pass, and moved
up by the totals of the earlier ranges of their group, one small row a range. A group of any size
spreads over all ranges, and rows that are equal in everything are told apart by their place in the
file that they were written to, so that copies spread as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.llm.shared import on_workers, shuffle_partitions, written


def first_of_runs(column: pa.Array) -> np.ndarray:
    """Which rows differ from the one before; null equals null. The first row counts as different."""
    codes = np.asarray(column.dictionary_encode().indices.fill_null(-1))
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    return new


def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``before``, the sum of ``amount`` over the rows of this range and group so far."""
    group, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("grp")
        amount = np.asarray(batch.column("amount"))
        before = np.cumsum(amount) - amount
        first = np.flatnonzero(first_of_runs(column))
        base = before[first].copy()
        if column[0].as_py() == group:
            base[0] -= total
        before = before - np.repeat(base, np.diff(np.append(first, len(amount))))
        group, total = column[-1].as_py(), int(before[-1] + amount[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], [*batch.schema.names, "before"])


def running_totals(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` plus ``start``, the sum of ``amount`` of the rows before in the group, and ``total``, the group's sum.

    ``rows`` has ``grp`` (nulls are a group) and ``amount`` (a long, not null); its columns must not
    be called part, before, start or total. Rows equal in grp and ``order`` stand in any order that
    a written copy of them gives.
    """
    spark = rows.sparkSession
    on_workers(spark)
    kept = written(rows, name).withColumn("_row", F.col("_metadata.row_index"))
    by = ["grp", *order, "_row"]
    dealt = kept.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by).drop("_row")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    dealt = written(dealt.mapInArrow(running, T.StructType([*dealt.schema, T.StructField("before", T.LongType())])), name)
    parts = dealt.groupBy("grp", "part").agg(F.sum("amount").alias("own"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        parts.select(
            F.col("grp").alias("_grp"),
            F.col("part").alias("_part"),
            F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("offset"),
            F.sum("own").over(group).alias("total"),
        ),
        "offsets",
    )
    joined = dealt.join(offsets, (F.col("part") == F.col("_part")) & F.col("grp").eqNullSafe(F.col("_grp")))
    return joined.select(*rows.columns, (F.col("before") + F.col("offset")).alias("start"), "total")
