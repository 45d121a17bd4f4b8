"""Summaries per slice, without and with filled gaps."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions.time import from_micros_sql, quoted
from gapweave.operators.fill import Fill, fill_options, fill_series, lines, slice_states, unfold_lines
from gapweave.operators.slices import BLOCK_SLICES, time_slice
from gapweave.session import require_ntz

Aggregates = dict[str, "str | Callable[[Column], Column]"]

DEFAULT_AGGS: Aggregates = {"min_temp": "min", "max_temp": "max", "avg_temp": "avg"}

# Summaries that can be put together from parts of a slice.
NAMED = {"min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum, "count": F.count}


def quantile(q: float, k: int = 200) -> Callable[[Column], Column]:
    """An aggregate for ``resample`` and ``interpolate_series``: a value whose rank is about ``q``.

    A mergeable sketch of bounded size (KLL), combined where the readings are read, so a slice may hold any
    number of values. Up to ``k`` values it is exact; beyond that the rank is off by about 1.65 % at k = 200, less in
    proportion for a larger k.
    """
    if not 0 <= q <= 1:
        raise ValueError("q is between 0 and 1")
    return lambda value: F.kll_sketch_get_quantile_double(
        F.kll_sketch_agg_double(value.cast("double"), F.lit(k)), F.lit(float(q))
    )


def _aggregate(how: str | Callable[[Column], Column], column: Column) -> Column:
    return NAMED[how](column) if isinstance(how, str) else how(column)


def resample(
    readings: DataFrame,
    step: timedelta,
    aggs: Aggregates,
    *,
    key: str = "wban",
    ts: str = "datetime",
    value: str = "temperature",
    rounding: str = "reference",
    slice_name: str = "slice",
) -> DataFrame:
    """Aggregates of the readings per series and epoch-aligned slice, gaps left out."""
    require_ntz(readings, ts)
    sliced = readings.where(F.col(ts).isNotNull()).select(
        key, time_slice(ts, step, rounding).alias(slice_name), value
    )
    return sliced.groupBy(key, slice_name).agg(
        *[_aggregate(how, F.col(value)).alias(name) for name, how in aggs.items()]
    )


def _from_states(readings: DataFrame, fill: Fill, aggs: Aggregates) -> DataFrame:
    """(_key, slot_us, one column per aggregate), one row per dense slice."""
    # With independent anchors a reading without a value is never filled; it only
    # matters if it has to raise the division by zero.
    with_inner = fill.paired or fill.on_degenerate == "error"
    return summaries(slice_states(readings, fill, with_inner), fill, aggs)


def summary_lines(states: DataFrame, fill: Fill, aggs: Aggregates) -> DataFrame:
    """``lines`` of states with their neighbours, with own_<how>, the aggregates of the state's own readings."""
    # Values shared by the readings before the first known one of the slice, after the
    # last, and by all of a slice without any.
    if fill.paired:
        lead = fill.between("slice_us", "px", "py", "xf", "yf")
        trail = fill.between("slice_us", "xl", "yl", "nx", "ny")
        bare = fill.between("slice_us", "px", "py", "nx", "ny")
    else:
        lead = fill.between("slice_us", "slice_us", "py", "slice_us", "yf")
        trail = fill.between("slice_us", "slice_us", "yl", "slice_us", "ny")
        bare = fill.between("slice_us", "slice_us", "py", "slice_us", "ny")
    states = states.selectExpr(
        "*",
        f"CASE WHEN lead_n > 0 THEN {lead} END AS lead",
        f"CASE WHEN trail_n > 0 THEN {trail} END AS trail",
        f"CASE WHEN observed = 0 AND readings > 0 THEN {bare} END AS bare",
    )
    total = "(total + coalesce(lead * lead_n, 0D) + coalesce(trail * trail_n, 0D))"
    count = "(known + if(lead IS NULL, 0L, lead_n) + if(trail IS NULL, 0L, trail_n))"
    own = {
        "min": "CASE WHEN observed > 0 THEN least(lo, lead, trail) ELSE bare END",
        "max": "CASE WHEN observed > 0 THEN greatest(hi, lead, trail) ELSE bare END",
        "avg": f"CASE WHEN observed > 0 THEN {total} / {count} ELSE bare END",
        "sum": f"CASE WHEN observed > 0 THEN {total} ELSE bare * readings END",
        "count": f"CASE WHEN observed > 0 THEN {count} WHEN bare IS NULL THEN 0L ELSE readings END",
    }
    return lines(states, fill, {f"own_{how}": own[how] for how in dict.fromkeys(aggs.values())})


def unfolded_summaries(shared: DataFrame, fill: Fill, aggs: Aggregates) -> DataFrame:
    """(_key, slot_us, one column per aggregate) from ``summary_lines``."""
    rows = unfold_lines(shared, fill, [f"own_{how}" for how in dict.fromkeys(aggs.values())])
    gap = {how: "gap" for how in NAMED} | {"count": "if(gap IS NULL, 0L, 1L)"}
    return rows.selectExpr(
        *("_key", "slot_us"),
        *[f"if(own, own_{how}, {gap[how]}) AS {quoted(name)}" for name, how in aggs.items()],
    )


def summaries(states: DataFrame, fill: Fill, aggs: Aggregates) -> DataFrame:
    """(_key, slot_us, one column per aggregate) from states with their neighbours."""
    return unfolded_summaries(summary_lines(states, fill, aggs), fill, aggs)


def interpolate_series(
    readings: DataFrame,
    start: datetime | date | str,
    end: datetime | date | str,
    step: timedelta,
    keys: DataFrame | list | None = None,
    *,
    key: str = "wban",
    ts: str = "datetime",
    value: str = "temperature",
    aggs: Aggregates = DEFAULT_AGGS,
    method: str = "linear",
    rounding: str = "reference",
    anchors: str = "paired",
    on_degenerate: str = "error",
    strict_alignment: bool = True,
    ordered: bool = False,
    block_slices: int = BLOCK_SLICES,
) -> DataFrame:
    """Dense slices of many series with gaps filled, summarised per slice.

    One row per series and slice: ``r_<key>``, ``r_slice`` and the aggregates (by
    default min_temp, max_temp, avg_temp). ``keys`` is a list, a DataFrame whose
    first column names the series, ``"range"`` for the series with readings in the range, or None for every
    series of ``readings``, which reads the keys of the whole table: on a long history, name the
    series or pass the station table. A series without readings in the range gets NULLs. An aggregate is one of min, max, avg,
    sum, count, or a function from column to aggregate; with only named ones the
    readings are aggregated where they are scanned, with a function the filled rows
    are. ``ordered`` adds the sort by series and slice.
    """
    if all(isinstance(how, str) for how in aggs.values()):
        unknown = [how for how in aggs.values() if how not in NAMED]
        if unknown:
            raise ValueError(f"unknown aggregates {unknown}; use {sorted(NAMED)} or a function")
        fill = fill_options(
            start, end, step, strict_alignment, block_slices,
            key=key, ts=ts, value=value, rounding=rounding, anchors=anchors,
            on_degenerate=on_degenerate, method=method, keys=keys,
        )
        result = _from_states(readings, fill, aggs).selectExpr(
            f"_key AS {quoted('r_' + key)}",
            f"{from_micros_sql('slot_us')} AS r_slice",
            *map(quoted, aggs),
        )
    else:
        filled = fill_series(
            readings, start, end, step, keys,
            method=method, key=key, ts=ts, value=value, rounding=rounding, anchors=anchors,
            on_degenerate=on_degenerate, strict_alignment=strict_alignment,
            slice_name="r_slice", filled_name="_filled", block_slices=block_slices,
        )
        result = filled.groupBy(F.col(key).alias(f"r_{key}"), "r_slice").agg(
            *[_aggregate(how, F.col("_filled")).alias(name) for name, how in aggs.items()]
        )
    return result.orderBy(f"r_{key}", "r_slice") if ordered else result
