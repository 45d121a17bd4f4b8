"""Gap detection and the previous reading of each reading.

LAG over a whole series would shuffle every reading and put one long series into one
task. Two readings in the same bucket of ``threshold`` + 1 microsecond cannot be a
gap, so only the first and last instant of each bucket matter, and those are found
by a map-side combined aggregation whatever the skew. The buckets are then compared
in blocks of bounded length, and the blocks with each other the same way.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions.time import epoch_micros, floor_to, from_micros
from gapweave.session import require_ntz

# Buckets of one series that one window group may hold.
FAN = 2**20

# A series is not cut into blocks at all if the whole range of a timestamp, year 1 to
# 9999, has no more buckets than this: the real span of a series is a small part of it.
TOP = 2**27

# Equal readings that one array unfolds into.
COPIES = 65_536
SPAN_US = 10_000 * 366 * 86_400_000_000


def _with_previous(level: DataFrame, group: list[str]) -> DataFrame:
    return level.withColumn("previous", F.lag("hi").over(Window.partitionBy(*group).orderBy("lo")))


def _consecutive(
    firsts_and_lasts: DataFrame, width: int, longer_than: int, fan: int, top: int
) -> DataFrame:
    """Pairs (previous last, first) of neighbouring rows, found level by level.

    Input: one row per _key and ``width`` of time, with first and last instant (lo,
    hi) and a payload n of the first. Neighbours lie either inside one block of ``fan``
    rows or at the border of two blocks, where they are the last and first of theirs,
    so the pairs of all levels together are the pairs of the whole series.
    """
    found = []
    level = firsts_and_lasts
    while SPAN_US // width > top:
        width *= fan
        group = ["_key", "_block"]
        # One exchange serves the window and the aggregation to the next level.
        level = level.withColumn("_block", floor_to(F.col("lo"), width)).repartition(*group)
        found.append(_with_previous(level, group).where(F.col("previous").isNotNull()))
        level = level.groupBy(*group).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min_by("n", "lo").alias("n")
        )
    found.append(_with_previous(level, ["_key"]))
    cols = ["_key", "lo", "previous", "n"]
    rows = reduce(DataFrame.unionAll, [f.select(*cols) for f in found])
    return rows if longer_than < 0 else rows.where(F.col("lo") - F.col("previous") > longer_than)


def find_gaps(
    readings: DataFrame,
    threshold_s: float = 3600,
    key: str = "wban",
    ts: str = "datetime",
    fan: int = FAN,
    top: int = TOP,
) -> DataFrame:
    """Consecutive readings of a series more than ``threshold_s`` seconds apart.

    Columns: key, ``current_datetime``, ``previous_datetime``. Exactly the rows of
    LAG over (partition by key order by ts) with a strictly greater difference:
    first readings and readings without a time are never reported.
    """
    if threshold_s < 0:
        raise ValueError("threshold_s must not be negative")
    require_ntz(readings, ts)
    longest = math.floor(round(threshold_s * 1_000_000, 3))
    buckets = (
        readings.where(F.col(ts).isNotNull())
        .select(F.col(key).alias("_key"), epoch_micros(ts).alias("us"))
        .groupBy("_key", floor_to(F.col("us"), longest + 1).alias("bucket"))
        .agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
        .select("_key", "lo", "hi", F.lit(1).alias("n"))
    )
    return _consecutive(buckets, longest + 1, longest, fan, top).select(
        F.col("_key").alias(key),
        from_micros("lo").alias("current_datetime"),
        from_micros("previous").alias("previous_datetime"),
    )


def previous_reading(
    readings: DataFrame, key: str = "wban", ts: str = "datetime", fan: int = FAN, top: int = TOP
) -> DataFrame:
    """LAG of the reading time per series, without the threshold.

    One row per distinct instant: key, ts, ``previous_datetime`` (NULL at the first)
    and ``copies``, the number of readings at that instant. LAG of the further
    ``copies - 1`` readings is the instant itself.
    """
    require_ntz(readings, ts)
    instants = (
        readings.where(F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("_key"), epoch_micros(ts).alias("lo"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_key", "lo", F.col("lo").alias("hi"), "n")
    )
    return _consecutive(instants, 1, -1, fan, top).select(
        F.col("_key").alias(key),
        from_micros("lo").alias(ts),
        from_micros("previous").alias("previous_datetime"),
        F.col("n").alias("copies"),
    )


def previous_reading_rows(
    readings: DataFrame,
    key: str = "wban",
    ts: str = "datetime",
    name: str = "previous_datetime",
    fan: int = FAN,
    top: int = TOP,
) -> DataFrame:
    """LAG of the reading time for each reading, with all its columns.

    Of several readings at one instant, the one whose columns have the smallest hash
    comes first; for the others the previous time is the instant itself. Equal rows are
    combined before anything is moved and repeated at the end, in blocks of ``COPIES``,
    so a hot instant never has to be put in order row by row. Readings without a time
    drop out, as in ``previous_reading``.
    """
    columns = readings.columns
    before = previous_reading(readings.select(key, ts), key, ts, fan, top).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col("previous_datetime").alias("_before")
    )
    rows = readings.where(F.col(ts).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_hash", F.xxhash64(*columns))
    first = rows.groupBy(F.col(key).alias("_key"), F.col(ts).alias("_ts")).agg(F.min("_hash").alias("_first"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(ts) == F.col("_ts"))
    leading = first.withColumnsRenamed({"_key": "_k", "_ts": "_t"}).join(
        before, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_t") == F.col("_ts"))
    ).drop("_k", "_t")
    joined = rows.join(leading, same)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}L"))).alias("_block")
    each = F.explode(
        F.sequence(F.col("_block") * COPIES, F.least((F.col("_block") + 1) * COPIES, F.col("_n")) - 1)
    ).alias("_copy")
    unfolded = joined.select("*", blocks).select("*", each)
    leads = (F.col("_hash") == F.col("_first")) & (F.col("_copy") == 0)
    return unfolded.select(*columns, F.when(leads, F.col("_before")).otherwise(F.col(ts)).alias(name))
