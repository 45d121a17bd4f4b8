"""The station dimension: joins, first record per key, upsert, keys and constraints.

No join carries a broadcast hint. Spark broadcasts the station side when its measured
size is below the threshold, and otherwise shuffles, splitting hot stations (AQE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions.scalar import is_blank
from gapweave.functions.time import quoted

SHORT_RANGE = (-32_768, 32_767)

# Hex digits of the hash that number the blocks of new keys: 4,096 blocks.
BLOCK_DIGITS = 3


def known_stations(
    observations: DataFrame, stations: DataFrame, key: str = "wban", unique: bool = False
) -> DataFrame:
    """Observations whose station exists.

    Repeated keys of the lookup are combined where they are read, so neither side of the
    join has a key more often than once on the right. With ``unique=True`` there are none.
    """
    keys = stations.select(key)
    return observations.join(keys if unique else keys.distinct(), key, "left_semi")


def new_stations(candidates: DataFrame, existing: DataFrame, key: str = "wban") -> DataFrame:
    """Candidates whose key is not there yet; repeated existing keys are combined where they are read."""
    return candidates.join(existing.select(key).distinct(), key, "left_anti")


def with_station_struct(stations: DataFrame, key: str = "wban") -> DataFrame:
    """key and ``station``: the nested station with its geo location in doubles."""
    location = F.struct(F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    nested = F.struct(
        key, "name", "state", "location", F.col("time_zone"), location.alias("geo_location")
    )
    return stations.select(key, nested.alias("station"))


def enrich_with_station(
    observations: DataFrame, stations: DataFrame, key: str = "wban", unique: bool = False
) -> DataFrame:
    """Observations with the columns of their station; unknown stations drop out.

    Pass ``unique=True`` if ``stations`` holds each key once; otherwise one record per
    key is taken first, so that no observation is multiplied. A broken promise fails the
    query instead of multiplying observations.
    """
    if unique:
        others = [c for c in stations.columns if c != key]
        twice = F.raise_error(F.concat(F.lit("station given twice: "), F.col("_group").cast("string")))
        once = F.when(F.count(F.lit(1)) == 1, F.any_value(F.struct(key, *others))).otherwise(twice)
        stations = stations.groupBy(F.col(key).alias("_group")).agg(once.alias("_one")).select("_one.*")
    else:
        others = [c for c in stations.columns if c != key]
        stations = dedupe_first(stations, key, F.struct(*others) if others else F.lit(0))
    return observations.join(stations, key, "inner")


def dedupe_first(df: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The first record of each key by ``order`` (rows with a NULL key or order drop out).

    An aggregation rather than a ranking: copies of a hot key are combined where they
    are read instead of meeting in one window.
    """
    order = F.col(order) if isinstance(order, str) else order
    first = F.min_by(F.struct(*df.columns), order)
    kept = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_group")).agg(first.alias("_first"))
    return kept.where(F.col("_first").isNotNull()).select("_first.*")


def assign_station_id(
    rows: DataFrame, key: str = "wban", after: DataFrame | int = 0, name: str = "station_id"
) -> DataFrame:
    """Number the rows 1, 2, 3, ... after the largest id so far, without gaps.

    ``key`` is unique and not NULL. Numbers follow the order of (first hex digits of
    md5(key), key). The hash spreads any keys evenly over a fixed number of blocks;
    rows are numbered inside their block, and only the block sizes, at most 4,096
    rows, go through a single task. ``after`` is a number or the existing table.
    """
    blocked = rows.withColumn("_block", F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, BLOCK_DIGITS))
    sizes = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(key))
    numbered = blocked.withColumn("_place", place).join(offsets, "_block")
    if isinstance(after, DataFrame):
        # a row of one number, read with the table that the rows are numbered after
        numbered = numbered.crossJoin(after.agg(F.coalesce(F.max(name), F.lit(0)).alias("_after")))
    else:
        numbered = numbered.withColumn("_after", F.lit(after))
    number = (F.col("_place") + F.col("_offset") + F.col("_after")).cast("int")
    return numbered.select(number.alias(name), *[F.col(c) for c in rows.columns])


def _to_short(name: str, source: str) -> Column:
    value = F.col(source)
    fits = value.isNull() | value.between(*SHORT_RANGE)
    message = F.concat(F.lit(f"{name} does not fit a smallint: "), value.cast("string"))
    return F.when(fits, value).otherwise(F.raise_error(message).cast("int")).cast("short").alias(name)


def to_station_rows(stations: DataFrame) -> DataFrame:
    """Station file records as rows of the station table, without the id.

    Blank text becomes NULL. A height or time zone beyond smallint fails the query.
    """
    text = [F.when(~is_blank(c), F.col(c)).alias(c) for c in ("wban", "name", "state", "location")]
    return stations.select(
        *text,
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        _to_short("ground_height", "ground_height"),
        _to_short("station_height", "station_height"),
        _to_short("timezone", "time_zone"),
    )


def upsert_stations(
    candidates: DataFrame, existing: DataFrame, order: Column | str, key: str = "wban"
) -> DataFrame:
    """Rows to append to ``existing``: the first candidate of each key not there yet, with ids.

    ``candidates`` has the columns of the table but the id, and possibly an order column.
    """
    fresh = new_stations(dedupe_first(candidates, key, order), existing, key)
    columns = [c for c in existing.columns if c != "station_id"]
    return assign_station_id(fresh.select(*columns), key, after=existing).select(*existing.columns)


def check_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def check_not_null(df: DataFrame, *names: str) -> DataFrame:
    """(column_name, violations) for each column that holds NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = ", ".join(f"'{c}', {quoted(c)}" for c in names)
    each = counts.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, violations)")
    return each.where(F.col("violations") > 0)
