"""Zone-free time arithmetic on ``timestamp_ntz`` columns.

Everything is counted in whole microseconds since 1970-01-01 as a bigint. The
obvious routes are not zone-free: ``timestampdiff`` and ``unix_micros`` read an NTZ
value through the session zone, which moves wall times inside a DST gap by an hour.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
HOUR_US = 3600 * SECOND_US
EPOCH = datetime(1970, 1, 1)

EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01'"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def interval_micros(interval: Column) -> Column:
    """Microseconds of a day-time interval. The cast alone would drop the fraction."""
    seconds = interval.cast("bigint")
    rest = interval - seconds * F.expr("INTERVAL '1' SECOND")
    return seconds * SECOND_US + (rest * SECOND_US).cast("bigint")


def epoch_micros(ts: Column | str) -> Column:
    if isinstance(ts, str):
        return F.expr(epoch_micros_sql(ts))
    return interval_micros(ts - F.expr(EPOCH_SQL))


def epoch_micros_sql(ts: str) -> str:
    """``epoch_micros`` of a named column as SQL text."""
    since = f"({quoted(ts)} - {EPOCH_SQL})"
    seconds = f"CAST({since} AS BIGINT)"
    return f"({seconds} * 1000000 + CAST(({since} - {seconds} * INTERVAL '1' SECOND) * 1000000 AS BIGINT))"


def from_micros(us: Column | str) -> Column:
    return F.timestamp_add("MICROSECOND", column(us), F.expr(EPOCH_SQL))


def from_micros_sql(us: str) -> str:
    return f"timestampadd(MICROSECOND, {us}, {EPOCH_SQL})"


def floor_to(us: Column, width: int) -> Column:
    """Largest multiple of ``width`` that is not above ``us`` (also before 1970)."""
    return us - F.pmod(us, F.lit(width))


def floor_to_sql(us: str, width: int) -> str:
    return f"({us} - pmod({us}, {width}L))"


def as_instant(value: datetime | date | str) -> int:
    """Microseconds since the epoch of a zone-less Python date, datetime or ISO string."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        raise ValueError("range bounds carry no time zone")
    return (value - EPOCH) // timedelta(microseconds=1)


def ntz_sql(us: int) -> str:
    """The instant as a SQL literal; beyond the years 1 to 9999, the nearest one inside."""
    us = min(max(us, as_instant(datetime.min)), as_instant(datetime.max))
    return f"TIMESTAMP_NTZ'{(EPOCH + timedelta(microseconds=us)).isoformat(sep=' ')}'"


def as_step(step: timedelta) -> int:
    """Slice width in microseconds; whole seconds only, as slices are counted in seconds."""
    if not isinstance(step, timedelta):
        raise TypeError("step must be a datetime.timedelta (months have no fixed length)")
    us = step // timedelta(microseconds=1)
    if us < SECOND_US or us % SECOND_US:
        raise ValueError("step must be a whole number of seconds, at least one")
    return us
