"""Time slices: putting instants into them and generating the ones expected."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions.time import (
    SECOND_US,
    as_instant,
    as_step,
    epoch_micros_sql,
    floor_to_sql,
    from_micros_sql,
    ntz_sql,
    quoted,
)

# Longest array one row is exploded from, and most slices in one window group.
BLOCK_SLICES = 65_536


def unfold_partitions(df: DataFrame) -> int:
    """Partitions for rows that unfold into many more: as many as Spark is set up to use in a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slice_micros_sql(us: str, step_us: int, rounding: str = "reference") -> str:
    """Start of the slice of an instant, both in microseconds since the epoch, as SQL text.

    ``'reference'`` first rounds to whole seconds (half to even), then divides with
    truncation towards zero: 01:59:59.7 belongs to 02:00, and the hour before 1970
    to 1970-01-01 00:00. ``'floor'`` takes the slice that contains the instant.
    """
    if rounding == "reference":
        return f"(CAST(rint({us} / 1e6D) AS BIGINT) div {step_us // SECOND_US}L * {step_us}L)"
    if rounding == "floor":
        return floor_to_sql(us, step_us)
    raise ValueError("rounding must be 'reference' or 'floor'")


def time_slice(ts: str, step: timedelta, rounding: str = "reference") -> Column:
    """Epoch-aligned slice start of the ``timestamp_ntz`` column named ``ts``."""
    return F.expr(from_micros_sql(slice_micros_sql(epoch_micros_sql(ts), as_step(step), rounding)))


def slice_micros(ts: str, step: timedelta, rounding: str = "reference") -> Column:
    """``time_slice`` in microseconds since the epoch: half the cost, for grouping rows before they are few."""
    return F.expr(slice_micros_sql(epoch_micros_sql(ts), as_step(step), rounding))


@dataclass(frozen=True)
class SliceRange:
    """The dense slices start, start + step, ... up to and including end."""

    start_us: int
    end_us: int
    step_us: int
    block_slices: int = BLOCK_SLICES

    @classmethod
    def of(
        cls,
        start: datetime | date | str,
        end: datetime | date | str,
        step: timedelta,
        block_slices: int = BLOCK_SLICES,
    ) -> SliceRange:
        return cls(as_instant(start), as_instant(end), as_step(step), block_slices)

    @property
    def count(self) -> int:
        return max(0, (self.end_us - self.start_us) // self.step_us + 1)

    @property
    def blocks(self) -> int:
        return -(-self.count // self.block_slices)

    @property
    def block_us(self) -> int:
        return self.block_slices * self.step_us

    @property
    def stop_us(self) -> int:
        """First slice start after the range."""
        return self.start_us + self.count * self.step_us

    @property
    def aligned(self) -> bool:
        """Whether slices of the range coincide with epoch-aligned slices at all."""
        return self.start_us % self.step_us == 0

    def check(self, strict_alignment: bool) -> None:
        if strict_alignment and not self.aligned:
            raise ValueError(
                "start is not a multiple of step counted from 1970-01-01, so no reading could "
                "meet a slice; pass strict_alignment=False for an all-NULL result"
            )

    def block_of_sql(self, slice_us: str) -> str:
        return f"({slice_us} - {self.start_us}L) div {self.block_us}L"

    def block_starts(self, keys: DataFrame, slice_us: str) -> DataFrame:
        """``keys`` times the first slice of every block."""
        if self.blocks == 0:
            return keys.selectExpr("*", f"{self.start_us}L AS {slice_us}").where("false")
        last = self.start_us + (self.blocks - 1) * self.block_us
        starts = f"sequence({self.start_us}L, {last}L, {self.block_us}L)"
        return keys.selectExpr("*", f"explode({starts}) AS {slice_us}")

    def restrict(self, readings: DataFrame, ts: str, slice_us: str, rounding: str) -> DataFrame:
        """Readings whose slice is one of the range's, with that slice as a column.

        The plain bounds on ``ts`` are a superset (they allow for the rounding and
        for the wide slice around the epoch) that the file scan can prune with.
        """
        if not self.aligned or self.count == 0:
            return readings.selectExpr("*", f"CAST(NULL AS BIGINT) AS {slice_us}").where("false")
        margin = self.step_us + SECOND_US
        low, high = ntz_sql(self.start_us - margin), ntz_sql(self.stop_us + margin)
        slice_of = slice_micros_sql(epoch_micros_sql(ts), self.step_us, rounding)
        return (
            readings.where(f"{quoted(ts)} BETWEEN {low} AND {high}")
            .selectExpr("*", f"{slice_of} AS {slice_us}")
            .where(f"{slice_us} BETWEEN {self.start_us}L AND {self.stop_us - self.step_us}L")
        )


def dense_series(
    keys: DataFrame,
    start: datetime | date | str,
    end: datetime | date | str,
    step: timedelta,
    slice_name: str = "slice",
) -> DataFrame:
    """Every row of ``keys`` with every slice from ``start`` to ``end`` (inclusive).

    Starts at ``start`` whatever its alignment; empty if ``end`` is before it. Long
    series are generated block by block, and the blocks, or the keys, are spread over the
    cluster before they unfold: a small file of keys, or few keys with many slices, still
    makes many tasks. Slices unfold as timestamps, without any arithmetic for each.
    """
    slices = SliceRange.of(start, end, step)
    if slices.count == 0:
        return keys.selectExpr("*", f"{ntz_sql(slices.start_us)} AS {quoted(slice_name)}").where("false")
    # What is shuffled is tiny before it unfolds, so the number is fixed, not coalesced by size.
    number = unfold_partitions(keys)
    by_step = f"INTERVAL '{slices.step_us // SECOND_US}' SECOND"
    last_us = slices.stop_us - slices.step_us
    if slices.blocks == 1:  # one array for all keys; dealt out in turn, as a key may be given many times
        starts = keys.repartition(number)
        each = f"sequence({from_micros_sql(f'{slices.start_us}L')}, {from_micros_sql(f'{last_us}L')}, {by_step})"
    else:
        starts = slices.block_starts(keys, "_start_us").repartition(number, *keys.columns, "_start_us")
        last = f"least(_start_us + {slices.block_us - slices.step_us}L, {last_us}L)"
        each = f"sequence({from_micros_sql('_start_us')}, {from_micros_sql(last)}, {by_step})"
    return starts.selectExpr(*map(quoted, keys.columns), f"explode({each}) AS {quoted(slice_name)}")
