"""Carrying the last known value forwards and the next known one backwards.

A window over one whole series would put a long series into one task. Here a window
never spans more than one block of a series; what has to cross block borders is the
last and first known value of each block, one small row per block, which is carried
in a second window and joined back. "Last known" is associative, so the result is
that of the single long window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions.time import column, quoted


def first_non_null(value: Column | str, order: Column | str) -> Column:
    """Aggregate: the first non-NULL value by ``order``."""
    return F.min_by(column(value), F.when(column(value).isNotNull(), column(order)))


def last_non_null(value: Column | str, order: Column | str) -> Column:
    """Aggregate: the last non-NULL value by ``order``."""
    return F.max_by(column(value), F.when(column(value).isNotNull(), column(order)))


def _window(group: list[str], order: str, frame: str) -> str:
    return f"OVER (PARTITION BY {', '.join(map(quoted, group))} ORDER BY {order} {frame})"


def carry(
    points: DataFrame,
    series: list[str],
    order: str,
    back: dict[str, str],
    ahead: dict[str, str],
    inclusive: bool,
    block: str | None = None,
    next_order: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add, per series, the last known values before each point and the next ones after it.

    ``back`` and ``ahead`` map new columns to the columns they are carried from;
    ``order`` is unique within a series, and no series column is NULL. ``inclusive``
    counts the point itself as before and after. ``next_order`` names a column for the
    order of the following point (of the same block).

    ``partitions`` fixes the number of partitions of blocks, for points that unfold later.

    Going ahead is a window in descending order: a frame that ends at the last row
    would be evaluated afresh for every row.
    """
    group = series + ([block] if block else [])
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW" if inclusive else before
    up, down = _window(group, f"{order} ASC", upto), _window(group, f"{order} DESC", upto)
    added = [f"last({source}, true) {up} AS {new}" for new, source in back.items()]
    added += [f"last({source}, true) {down} AS {new}" for new, source in ahead.items()]
    if next_order:
        added.append(f"lead({order}) {_window(group, f'{order} ASC', '')} AS {next_order}")
    if block is None:
        return points.selectExpr("*", *added)

    # Both readers below share this exchange, if they ask for the same columns: "_seen",
    # never NULL, makes the summary ask for all.
    points = points.repartition(partitions, *group) if partitions else points.repartition(*group)
    seen = F.max(F.xxhash64(*points.columns)).alias("_seen")
    edges = [f"max_by({x}, CASE WHEN {x} IS NOT NULL THEN {order} END) AS _{new}" for new, x in back.items()]
    edges += [f"min_by({x}, CASE WHEN {x} IS NOT NULL THEN {order} END) AS _{new}" for new, x in ahead.items()]
    up, down = _window(series, f"{block} ASC", before), _window(series, f"{block} DESC", before)
    borders = (
        points.groupBy(*group)
        .agg(*map(F.expr, edges), seen)
        .where("_seen IS NOT NULL")
        .selectExpr(
            *map(quoted, group),
            *[f"last(_{new}, true) {up} AS _{new}" for new in back],
            *[f"last(_{new}, true) {down} AS _{new}" for new in ahead],
        )
    )
    # Plain equality on the very columns of the exchange above, so the points stay put.
    whole = points.selectExpr("*", *added).join(borders, group, "left")
    return whole.selectExpr(
        *map(quoted, points.columns),
        *[f"coalesce({new}, _{new}) AS {new}" for new in [*back, *ahead]],
        *([next_order] if next_order else []),
    )
