"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gapweave.functions.time import HOUR_US, SECOND_US, column, epoch_micros, interval_micros


SAME_X = "linear_interpolate: both points have the same x"


def datediff_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end`` as a double, fraction kept."""
    return interval_micros(column(end) - column(start)) / F.lit(1e6)


def timestamp_to_seconds(ts: Column | str) -> Column:
    """Seconds since 1970-01-01 as a double, fraction kept."""
    return epoch_micros(ts) / F.lit(1e6)


def linear_interpolate(
    x: Column | str,
    x0: Column | str,
    y0: Column | str,
    x1: Column | str,
    y1: Column | str,
    on_degenerate: str = "error",
) -> Column:
    """Value at ``x`` of the line through (x0, y0) and (x1, y1); NULL if any input is.

    For x0 = x1 there is no line: ``on_degenerate='error'`` fails the query,
    ``'null'`` gives NULL.
    """
    x, x0, y0, x1, y1 = (column(c).cast("double") for c in (x, x0, y0, x1, y1))
    rise, run = y1 - y0, x1 - x0
    slope = rise / F.nullif(run, F.lit(0.0))
    if on_degenerate == "error":
        # Explicit, so that it also fails where ANSI mode is off.
        slope = F.when(rise.isNotNull() & (run == 0.0), F.raise_error(F.lit(SAME_X)).cast("double")).otherwise(
            slope
        )
    elif on_degenerate != "null":
        raise ValueError("on_degenerate must be 'error' or 'null'")
    return slope * (x - x0) + y0


def slope_sql(x0: str, y0: str, x1: str, y1: str, on_degenerate: str) -> str:
    """The slope in ``linear_interpolate`` of double expressions as SQL text."""
    rise, run = f"({y1} - {y0})", f"({x1} - {x0})"
    slope = f"{rise} / nullif({run}, 0D)"
    if on_degenerate == "error":
        fail = f"CAST(raise_error('{SAME_X}') AS DOUBLE)"
        slope = f"CASE WHEN {rise} IS NOT NULL AND {run} = 0D THEN {fail} ELSE {slope} END"
    return f"({slope})"


def linear_interpolate_sql(x: str, x0: str, y0: str, x1: str, y1: str, on_degenerate: str) -> str:
    """``linear_interpolate`` of double expressions as SQL text."""
    return f"({slope_sql(x0, y0, x1, y1, on_degenerate)} * ({x} - {x0}) + {y0})"


def linear_interpolate_ts(
    t: Column | str,
    t0: Column | str,
    y0: Column | str,
    t1: Column | str,
    y1: Column | str,
    on_degenerate: str = "error",
) -> Column:
    """The same with timestamps on the x axis."""
    return linear_interpolate(
        timestamp_to_seconds(t),
        timestamp_to_seconds(t0),
        y0,
        timestamp_to_seconds(t1),
        y1,
        on_degenerate,
    )


def at_time(date: Column | str, seconds_of_day: Column | str) -> Column:
    """A date plus a time of day (in seconds) as ``timestamp_ntz``."""
    day = column(date).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.rint(column(seconds_of_day).cast("double") * SECOND_US).cast("bigint"), day)


def to_utc(local: Column | str, offset_hours: Column | str | float) -> Column:
    """Instant (``timestamp``) of a wall time at a fixed offset from UTC, in hours."""
    if isinstance(offset_hours, (int, float)):
        offset_hours = F.lit(offset_hours)
    shift = F.rint(column(offset_hours).cast("double") * HOUR_US).cast("bigint")
    return F.timestamp_micros(epoch_micros(local) - shift)


# Characters up to U+0020. SQL trim strips spaces only.
BLANKS = "".join(chr(n) for n in range(0x21))


def trim_cell(text: Column | str) -> Column:
    """Strip characters up to U+0020 at both ends."""
    return F.btrim(column(text), F.lit(BLANKS))


def is_blank(text: Column | str) -> Column:
    """NULL, empty, or nothing but characters up to U+0020."""
    return column(text).isNull() | (trim_cell(text) == "")


def parse_missing(text: Column | str, type_name: str, sentinels: tuple[str, ...] = ()) -> Column:
    """Typed value of a text cell; NULL for a sentinel and for text that does not parse."""
    cell = trim_cell(text)
    if sentinels:
        cell = F.when(cell.isin(*sentinels), F.lit(None)).otherwise(cell)
    return F.when(cell != "", cell).try_cast(type_name)


def cell_is_valid(text: Column | str, type_name: str, sentinels: tuple[str, ...] = ()) -> Column:
    """Whether the cell is present and either a sentinel or parses; never NULL."""
    cell = trim_cell(text)
    ok = parse_missing(text, type_name).isNotNull()
    if sentinels:
        ok = ok | F.coalesce(cell.isin(*sentinels), F.lit(False))
    return ok


def parse_datetime(date: Column | str, time: Column | str, day_overflow: str = "reject") -> Column:
    """``yyyyMMdd`` and ``HHmm`` cells to ``timestamp_ntz``; NULL where either is malformed.

    A day past the end of its month (20150231) is malformed by default;
    ``day_overflow='clamp'`` takes the last day of the month instead, as Java's
    default resolver does. Day 32 is malformed either way.
    """
    date, time = trim_cell(date), trim_cell(time)
    digits = F.when(date.rlike(r"\A[0-9]{8}\z") & time.rlike(r"\A[0-9]{4}\z"), F.concat(date, time))

    def part(pos: int, length: int) -> Column:
        return F.substring(digits, pos, length).cast("int")

    year, month, day = part(1, 4), part(5, 2), part(7, 2)
    if day_overflow == "clamp":
        first = F.to_date(F.try_make_timestamp_ntz(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
        day = F.when(day <= 31, F.least(day, F.dayofmonth(F.last_day(first)))).otherwise(day)
    elif day_overflow != "reject":
        raise ValueError("day_overflow must be 'reject' or 'clamp'")
    return F.try_make_timestamp_ntz(year, month, day, part(9, 2), part(11, 2), F.lit(0))
