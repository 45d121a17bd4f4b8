"""Aligning readings to the dense slices and filling the slices that have none.

The work is done per slice, not per reading. A map-side combined aggregation turns
the readings of a slice into one row (its "state": counts, extremes, first and last
known reading). Everything an empty slice needs is the last known reading of an
earlier state and the next known one of a later state, and empty slices themselves
are not joined in: each state unfolds into itself and the empty slices up to the
next one. Readings that have a value never meet a window at all.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.scalar import slope_sql
from gapweave.functions.time import (
    SECOND_US,
    epoch_micros_sql,
    floor_to_sql,
    from_micros,
    from_micros_sql,
    quoted,
)
from gapweave.operators.carry import carry
from gapweave.operators.slices import BLOCK_SLICES, SliceRange, unfold_partitions
from gapweave.session import require_ntz

# Widest window group inside one slice. Instants are distinct microseconds there, so
# such a group has a bounded number of rows whatever the data.
SUB_SLICE_US = 16 * SECOND_US

# Tasks that a hot series is spread over when the series are chosen by a shuffled join.
KEY_SALTS = 16

# As keys: the series with readings in the range, so that no other part of the table is read.
RANGE = "range"

METHODS = ("linear", "forward", "backward")


@dataclass(frozen=True)
class Fill:
    """What is filled, over which slices, and how. All the choices of one job.

    ``anchors`` decides which time goes with a known value. ``'paired'`` takes the
    time of the reading that has the value. ``'independent'`` takes the last reading
    time and the last known value each for itself, so a reading without a value lends
    its time to the value of another one.
    """

    slices: SliceRange
    key: str = "wban"
    ts: str = "datetime"
    value: str = "temperature"
    rounding: str = "reference"
    anchors: str = "paired"
    on_degenerate: str = "error"
    method: str = "linear"
    keys: DataFrame | list | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        if self.anchors not in ("paired", "independent"):
            raise ValueError("anchors must be 'paired' or 'independent'")
        if self.on_degenerate not in ("error", "null"):
            raise ValueError("on_degenerate must be 'error' or 'null'")
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")

    @property
    def paired(self) -> bool:
        return self.anchors == "paired"

    def wanted(self, readings: DataFrame) -> DataFrame:
        """Readings with a key, restricted to a listed set of keys by the scan."""
        require_ntz(readings, self.ts)
        if isinstance(self.keys, (list, tuple)):
            return readings.where(F.col(self.key).isin(list(self.keys)))
        return readings.where(F.col(self.key).isNotNull())

    def series(self, readings: DataFrame) -> DataFrame:
        """One row (_key) per series that must appear in the result."""
        kind = readings.schema[self.key].dataType
        if self.keys is None:
            return self.wanted(readings).selectExpr(f"{quoted(self.key)} AS _key").distinct()
        if isinstance(self.keys, str):
            if self.keys != RANGE:
                raise ValueError(f"keys is a list, a DataFrame, None or {RANGE!r}")
            inside = self.slices.restrict(self.wanted(readings), self.ts, "_slice_us", self.rounding)
            return inside.selectExpr(f"{quoted(self.key)} AS _key").distinct()
        if isinstance(self.keys, DataFrame):
            chosen = self.keys.select(F.col(self.keys.columns[0]).cast(kind).alias("_key"))
            return chosen.where("_key IS NOT NULL").distinct()
        schema = T.StructType([T.StructField("_key", kind)])
        return readings.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(self.keys)], schema)

    def in_range(self, readings: DataFrame) -> DataFrame:
        """(_key, slice_us, us, v) of the readings that fall into one of the slices."""
        placed = self.slices.restrict(self.wanted(readings), self.ts, "_slice_us", self.rounding)
        rows = placed.selectExpr(
            f"{quoted(self.key)} AS _key",
            "_slice_us AS slice_us",
            f"{epoch_micros_sql(self.ts)} AS us",
            f"CAST({quoted(self.value)} AS DOUBLE) AS v",
        )
        return self.chosen(readings, rows, "us")

    def chosen(self, readings: DataFrame, rows: DataFrame, us: str, key: str = "_key") -> DataFrame:
        """``rows`` of the series that a DataFrame names, before anything is aggregated.

        Keys few enough are broadcast by Spark, and rows of other series go where they are
        read. If the join is shuffled, a salt from the time spreads a hot series over
        ``KEY_SALTS`` tasks, and the aggregation after it combines before it shuffles again.
        """
        if not isinstance(self.keys, DataFrame):
            return rows
        salts = f"explode(sequence(0L, {KEY_SALTS - 1}L)) AS _salt"
        keys = self.series(readings).selectExpr(f"_key AS {quoted(key)}", salts)
        salted = rows.selectExpr("*", f"pmod(xxhash64({us}), {KEY_SALTS}L) AS _salt")
        return salted.join(keys, [key, "_salt"], "left_semi").drop("_salt")

    def slope(self, x0: str, y0: str, x1: str, y1: str) -> str:
        """SQL text of the slope between two anchors, times in microseconds."""
        return slope_sql(f"{x0} / 1e6D", y0, f"{x1} / 1e6D", y1, self.on_degenerate)

    def between(self, x_us: str, x0: str, y0: str, x1: str, y1: str) -> str:
        """SQL text of the fill value at ``x_us`` from the anchors on both sides."""
        if self.method == "forward":
            return y0
        if self.method == "backward":
            return y1
        return f"({self.slope(x0, y0, x1, y1)} * ({x_us} / 1e6D - {x0} / 1e6D) + {y0})"


def tie_break_sql(value: str, bits: int) -> str:
    """A number that orders different values of one instant the same way everywhere: of several, the
    one with the largest counts. Top bits of a hash, so that any number of bits gives the same order."""
    return f"shiftrightunsigned(xxhash64({value}), {64 - bits})" if bits else "0L"


def _tie_bits(step_us: int) -> int:
    """Bits left over next to a time within a slice in a bigint."""
    return max(0, 62 - (2 * (step_us + SECOND_US)).bit_length())


def _place_in_slice_sql(step_us: int, first: bool, us: str = "us", v: str = "v") -> str:
    """Order of a reading within its slice as one bigint: the time, then the tie break, such that
    the same value of an instant comes first among the first and last among the last.

    A bigint keeps the aggregation a hash aggregation; ordering by a struct would sort
    every reading first.
    """
    bits = _tie_bits(step_us)
    tie = tie_break_sql(v, bits)
    return f"({us} - slice_us) * {1 << bits}L + {f'({(1 << bits) - 1}L - {tie})' if first else tie}"


def reading_states(rows: DataFrame, fill: Fill) -> DataFrame:
    """One row per series and slice of ``rows`` (_key, slice_us, us, v).

    Columns: _key, slice_us, readings, observed (readings with a value); lo, hi, total
    of the values; kf, kl, yf, yl, time and value of the first and last known reading;
    null_lo, null_hi, the first and last time of a reading without a value.
    """
    early, late = (
        f"CASE WHEN v IS NOT NULL THEN {_place_in_slice_sql(fill.slices.step_us, first)} END"
        for first in (True, False)
    )
    return rows.groupBy("_key", "slice_us").agg(
        F.expr("count(us) AS readings"),
        F.expr("count(v) AS observed"),
        F.expr("min(v) AS lo"),
        F.expr("max(v) AS hi"),
        F.expr("sum(v) AS total"),
        F.expr("min(CASE WHEN v IS NOT NULL THEN us END) AS kf"),
        F.expr("max(CASE WHEN v IS NOT NULL THEN us END) AS kl"),
        F.expr("min(CASE WHEN v IS NULL THEN us END) AS null_lo"),
        F.expr("max(CASE WHEN v IS NULL THEN us END) AS null_hi"),
        F.expr(f"min_by(v, {early}) AS yf"),
        F.expr(f"max_by(v, {late}) AS yl"),
    )


def merged_states(parts: DataFrame, fill: Fill) -> DataFrame:
    """States of readings that came in several parts, from the states of each part."""
    early = _place_in_slice_sql(fill.slices.step_us, True, "kf", "yf")
    late = _place_in_slice_sql(fill.slices.step_us, False, "kl", "yl")
    states = parts.groupBy("_key", "slice_us").agg(
        *[F.sum(n).alias(n) for n in ("readings", "observed", "total")],
        *[F.min(n).alias(n) for n in ("lo", "kf", "null_lo")],
        *[F.max(n).alias(n) for n in ("hi", "kl", "null_hi")],
        F.expr(f"min_by(yf, CASE WHEN kf IS NOT NULL THEN {early} END) AS yf"),
        F.expr(f"max_by(yl, CASE WHEN kl IS NOT NULL THEN {late} END) AS yl"),
    )
    return states.where(ALWAYS_TRUE)


def _states(readings: DataFrame, rows: DataFrame, fill: Fill) -> DataFrame:
    """``reading_states``, and a row per series and block start."""
    # A row at every block start makes each series appear, from the first slice on.
    starts = fill.slices.block_starts(fill.series(readings), "slice_us")
    nothing = ("CAST(NULL AS BIGINT) AS us", "CAST(NULL AS DOUBLE) AS v")
    parts = rows.unionAll(starts.selectExpr("_key", "slice_us", *nothing))
    states = reading_states(parts, fill)
    first, last = fill.slices.start_us, fill.slices.stop_us - fill.slices.step_us
    return states.where(f"slice_us BETWEEN {first}L AND {last}L AND {ALWAYS_TRUE}")


# Holds for every state, like the range of its slice. Naming all columns, and the range
# that Spark would otherwise infer for one reader only, makes every reader ask for the
# same aggregation, whatever it goes on to use; Spark runs that once and reuses it.
ALWAYS_TRUE = (
    "readings >= observed AND isnull(null_lo) = isnull(null_hi) AND isnull(kf) = isnull(yf) "
    "AND isnull(kl) = isnull(yl) AND isnull(lo) = isnull(hi) AND isnull(lo) = isnull(total)"
)

# A slice where a reading without a value may lie between known ones. Elsewhere they all
# come before the first or after the last known one.
ENTANGLED = "observed > 0 AND null_lo <= kl AND null_hi >= kf"


# Bits that tell which slices are entangled, in words of 64: 512 KiB, whatever the data.
FILTER_WORDS = 1 << 16
SLICE_BIT = f"pmod(xxhash64(_key, slice_us), {FILTER_WORDS * 64}L)"


def _entangled_bits(states: DataFrame) -> Column:
    """A scalar subquery: the array of words in which the bits of all entangled slices are set."""
    marks = states.where(ENTANGLED).selectExpr(f"{SLICE_BIT} AS bit")
    marks = marks.selectExpr("bit div 64 AS word", "shiftleft(1L, CAST(bit % 64 AS INT)) AS bits")
    every = states.sparkSession.range(FILTER_WORDS).selectExpr("id AS word", "0L AS bits")
    words = marks.unionAll(every).groupBy("word").agg(F.expr("bit_or(bits) AS bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits")).scalar()


def _between_readings(rows: DataFrame, states: DataFrame, fill: Fill) -> DataFrame:
    """Readings without a value in entangled slices: (_key, slice_us, us, copies, px, py,
    nx, ny), the anchors found in the same slice, both sides inclusive.

    A filter of fixed size, computed from the states before the readings are read again, picks the slices
    where the readings are read: none of the others is shuffled, whatever Spark can broadcast. A slice
    that shares its bit with an entangled one comes along and gets the numbers that its state has anyway.
    """
    bit = F.expr(SLICE_BIT)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    word = F.get(_entangled_bits(states), F.call_function("div", bit, F.lit(64)).cast("int"))
    rows = rows.where(word.bitwiseAND(mask) != 0)
    tie = tie_break_sql("v", _tie_bits(fill.slices.step_us))
    # Copies of a reading are combined before the shuffle, so that they never meet in one task.
    instants = (
        rows.groupBy("_key", "slice_us", "us")
        .agg(
            F.expr(f"max_by(v, CASE WHEN v IS NOT NULL THEN {tie} END) AS y"),
            F.expr("count_if(v IS NULL) AS copies"),
        )
        .selectExpr(
            *("*", "CASE WHEN y IS NOT NULL THEN us END AS x"), f"{floor_to_sql('us', SUB_SLICE_US)} AS sub"
        )
    )
    found = carry(
        instants,
        ["_key", "slice_us"],
        "us",
        back={"px": "x", "py": "y"},
        ahead={"nx": "x", "ny": "y"},
        inclusive=True,
        block="sub" if fill.slices.step_us > SUB_SLICE_US else None,
    )
    return found.where("copies > 0")


def with_inner_readings(states: DataFrame, rows: DataFrame, fill: Fill) -> DataFrame:
    """States plus what readings without a value contribute to slices with known ones.

    lo, hi, total and known (a count) then cover the values between known readings.
    Those before the first (after the last) known reading of the slice all get the
    same value, which depends on earlier (later) slices; lead_n and trail_n count them.
    """
    x0, x1 = ("px", "nx") if fill.paired else ("us", "us")
    value = fill.between("slice_us", x0, "py", x1, "ny")
    inner = (
        _between_readings(rows, states, fill)
        .selectExpr("*", f"CASE WHEN px IS NOT NULL AND nx IS NOT NULL THEN {value} END AS w")
        .groupBy("_key", "slice_us")
        .agg(
            F.expr("min(w) AS in_lo"),
            F.expr("max(w) AS in_hi"),
            F.expr("sum(w * copies) AS in_total"),
            F.expr("sum(CASE WHEN w IS NULL THEN 0L ELSE copies END) AS in_known"),
            F.expr("sum(CASE WHEN px IS NULL THEN copies ELSE 0L END) AS in_lead_n"),
            F.expr("sum(CASE WHEN nx IS NULL THEN copies ELSE 0L END) AS in_trail_n"),
        )
    )
    # Both sides are partitioned by these two columns already.
    joined = states.join(inner, ["_key", "slice_us"], "left")
    missing = "observed > 0 AND readings > observed"
    return joined.selectExpr(
        *("_key", "slice_us", "readings", "observed", "kf", "kl", "null_lo", "null_hi", "yf", "yl"),
        "least(lo, in_lo) AS lo",
        "greatest(hi, in_hi) AS hi",
        "total + coalesce(in_total, 0D) AS total",
        "observed + coalesce(in_known, 0L) AS known",
        f"coalesce(in_lead_n, if({missing} AND null_hi < kf, readings - observed, 0L)) AS lead_n",
        f"coalesce(in_trail_n, if({missing} AND null_lo > kl, readings - observed, 0L)) AS trail_n",
    )


def with_neighbours(states: DataFrame, fill: Fill, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the states plus yf, yl and xf, xl, the times that go with the first and last value, px, py, the
    last anchor of earlier slices, nx, ny, the first of later ones, and next_us, the
    slice of the following state or the end of the block.
    """
    slices = fill.slices
    if slices.blocks <= 1:
        # States unfold into more rows than the shuffled size shows, so the number of
        # partitions is fixed here instead of left to be coalesced by that size.
        states = states.repartition(unfold_partitions(states), "_key")
    first, last = ("kf", "kl") if fill.paired else ("least(kf, null_lo)", "greatest(kl, null_hi)")
    states = states.selectExpr("_key", "slice_us", *keep, "yf", "yl", f"{first} AS xf", f"{last} AS xl")
    block, block_end = None, f"{slices.stop_us}L"
    if slices.blocks > 1:
        block = "block"
        states = states.selectExpr("*", f"{slices.block_of_sql('slice_us')} AS block")
        block_end = f"least((block + 1) * {slices.block_us}L + {slices.start_us}L, {slices.stop_us}L)"
    states = carry(
        states,
        ["_key"],
        "slice_us",
        back={"px": "xl", "py": "yl"},
        ahead={"nx": "xf", "ny": "yf"},
        inclusive=False,
        block=block,
        next_order="following_us",
        partitions=unfold_partitions(states),
    )
    return states.selectExpr("*", f"coalesce(following_us, {block_end}) AS next_us")


# What a summary needs of a state besides its anchors.
SUMMARY = ["readings", "observed", "lo", "hi", "total", "known", "lead_n", "trail_n"]


def slice_states(readings: DataFrame, fill: Fill, with_inner: bool) -> DataFrame:
    """The states of a summary, ready to unfold."""
    rows = fill.in_range(readings)
    states = _states(readings, rows, fill)
    if with_inner:
        states = with_inner_readings(states, rows, fill)
    else:
        states = states.selectExpr("*", "observed AS known", "0L AS lead_n", "0L AS trail_n")
    return with_neighbours(states, fill, SUMMARY)


def lines(states: DataFrame, fill: Fill, own: dict[str, str]) -> DataFrame:
    """States ready to ``unfold``: _key, slice_us, next_us, occupied, the line of the empty slices, the expressions ``own``.

    What all slices of a state share is computed before it unfolds, so that a slice costs little. The line is
    x0, y0 and slope of a linear fill, else y0 alone.
    """
    x0, y0 = "coalesce(xl, px)", "coalesce(yl, py)"
    if fill.method == "linear":
        line = (f"{x0} / 1e6D AS x0", f"{y0} AS y0", f"{fill.slope(x0, y0, 'nx', 'ny')} AS slope")
    else:
        line = (f"{y0 if fill.method == 'forward' else 'ny'} AS y0",)
    return states.selectExpr(
        *("_key", "slice_us", "next_us", "readings > 0 AS occupied"),
        *line,
        *[f"{expression} AS {quoted(name)}" for name, expression in own.items()],
    )


def unfold_lines(shared: DataFrame, fill: Fill, own: Iterable[str]) -> DataFrame:
    """Each state of ``lines`` with readings, then the empty slices up to the next state.

    Columns: _key, slot_us, own (whether the row is the state itself), gap, the fill value of an empty slice, and
    those named in the argument.
    """
    step = fill.slices.step_us
    gap = "slope * (slot_us / 1e6D - x0) + y0" if fill.method == "linear" else "y0"
    return shared.selectExpr(
        "*", f"explode(sequence(slice_us, next_us - {step}L, {step}L)) AS slot_us"
    ).selectExpr(
        "_key", "slot_us", "occupied AND slot_us = slice_us AS own", f"{gap} AS gap", *map(quoted, own)
    )


def unfold(states: DataFrame, fill: Fill, own: dict[str, str]) -> DataFrame:
    """``lines`` of the states, unfolded."""
    return unfold_lines(lines(states, fill, own), fill, own)


def fill_options(start, end, step, strict_alignment, block_slices, **rest) -> Fill:
    slices = SliceRange.of(start, end, step, block_slices)
    slices.check(strict_alignment)
    return Fill(slices, **rest)


def _empty_slices(readings: DataFrame, fill: Fill) -> DataFrame:
    """(_key, slot_us, gap) of the slices without any reading."""
    states = _states(readings, fill.in_range(readings), fill)
    states = with_neighbours(states, fill, ["readings"])
    return unfold(states, fill, {}).where("NOT own").select("_key", "slot_us", "gap")


def align_to_series(
    readings: DataFrame,
    start: datetime | date | str,
    end: datetime | date | str,
    step: timedelta,
    keys: DataFrame | list | None = None,
    *,
    key: str = "wban",
    ts: str = "datetime",
    value: str = "temperature",
    rounding: str = "reference",
    strict_alignment: bool = True,
    slice_name: str = "slice",
    block_slices: int = BLOCK_SLICES,
) -> DataFrame:
    """Right outer join of the readings with the dense slices of their series.

    Every reading in range with its slice, and one row with NULLs for every slice
    that has none. The readings are not shuffled: the missing slices are worked out
    from the occupied ones and appended.
    """
    fill = fill_options(
        start, end, step, strict_alignment, block_slices,
        key=key, ts=ts, value=value, rounding=rounding, method="forward", keys=keys,
    )
    present = fill.slices.restrict(fill.wanted(readings), ts, "_slice_us", rounding)
    present = fill.chosen(readings, present, quoted(ts), key)
    present = present.withColumn(slice_name, from_micros("_slice_us")).drop("_slice_us")
    empty = _empty_slices(readings, fill).selectExpr(
        f"_key AS {quoted(key)}", f"{from_micros_sql('slot_us')} AS {quoted(slice_name)}"
    )
    return present.unionByName(empty, allowMissingColumns=True)


def fill_series(
    readings: DataFrame,
    start: datetime | date | str,
    end: datetime | date | str,
    step: timedelta,
    keys: DataFrame | list | None = None,
    *,
    method: str = "linear",
    key: str = "wban",
    ts: str = "datetime",
    value: str = "temperature",
    rounding: str = "reference",
    anchors: str = "paired",
    on_degenerate: str = "error",
    strict_alignment: bool = True,
    slice_name: str = "slice",
    filled_name: str = "filled",
    block_slices: int = BLOCK_SLICES,
) -> DataFrame:
    """The aligned rows with missing values filled: key, slice, ts, value, filled.

    ``method='linear'`` puts a missing value on the line between the last known and
    the next known reading, at the start of its slice; ``'forward'`` and
    ``'backward'`` repeat the last or next known one. Known values are kept. Readings
    outside the range are not anchors, so slices before the first and after the last
    known reading stay NULL in a linear fill.
    """
    fill = fill_options(
        start, end, step, strict_alignment, block_slices,
        key=key, ts=ts, value=value, rounding=rounding, anchors=anchors,
        on_degenerate=on_degenerate, method=method, keys=keys,
    )
    rows = fill.in_range(readings)
    known = rows.where("v IS NOT NULL").selectExpr("_key", "slice_us", "us", "v", "v AS w")
    missing = _fill_missing_readings(readings, rows, fill).selectExpr(
        "_key", "slice_us", "us", "CAST(NULL AS DOUBLE) AS v", "w"
    )
    empty = _empty_slices(readings, fill).selectExpr(
        *("_key", "slot_us AS slice_us", "CAST(NULL AS BIGINT) AS us", "CAST(NULL AS DOUBLE) AS v", "gap AS w")
    )
    return (
        known.unionAll(missing)
        .unionAll(empty)
        .selectExpr(
            f"_key AS {quoted(key)}",
            f"{from_micros_sql('slice_us')} AS {quoted(slice_name)}",
            f"{from_micros_sql('us')} AS {quoted(ts)}",
            f"v AS {quoted(value)}",
            f"w AS {quoted(filled_name)}",
        )
    )


def _fill_missing_readings(readings: DataFrame, rows: DataFrame, fill: Fill) -> DataFrame:
    """(_key, slice_us, us, w) for every reading without a value."""
    states = _states(readings, rows, fill)
    around = (
        with_neighbours(states, fill, ["readings", "observed", "kf", "kl"])
        .where("readings > observed")
        .select("_key", "slice_us", "kf", "yf", "kl", "yl", "px", "py", "nx", "ny")
    )
    inside = _between_readings(rows, states, fill).selectExpr(
        *("_key", "slice_us", "us", "px AS in_px", "py AS in_py", "nx AS in_nx", "ny AS in_ny")
    )
    found = (
        rows.where("v IS NULL")
        .select("_key", "slice_us", "us")
        .join(around, ["_key", "slice_us"], "left")
        .join(inside, ["_key", "slice_us", "us"], "left")
    )
    # The nearest known reading: between others, else the slice's own, else a neighbour's.
    px, py = "coalesce(in_px, if(us > kl, kl, px))", "if(in_px IS NOT NULL, in_py, if(us > kl, yl, py))"
    nx, ny = "coalesce(in_nx, if(us < kf, kf, nx))", "if(in_nx IS NOT NULL, in_ny, if(us < kf, yf, ny))"
    if not fill.paired:
        px = nx = "us"
    value = fill.between("slice_us", px, py, nx, ny)
    return found.selectExpr("_key", "slice_us", "us", f"{value} AS w")


def fill_forward(readings: DataFrame, start, end, step: timedelta, keys=None, **options) -> DataFrame:
    """``fill_series`` with the last known value carried forward."""
    return fill_series(readings, start, end, step, keys, method="forward", **options)


def fill_backward(readings: DataFrame, start, end, step: timedelta, keys=None, **options) -> DataFrame:
    """``fill_series`` with the next known value carried backward."""
    return fill_series(readings, start, end, step, keys, method="backward", **options)


def interpolate(readings: DataFrame, start, end, step: timedelta, keys=None, **options) -> DataFrame:
    """``fill_series`` on the straight line between the neighbours."""
    return fill_series(readings, start, end, step, keys, method="linear", **options)
