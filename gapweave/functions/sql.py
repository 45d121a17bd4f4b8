"""The functions for users who write SQL.

``register`` creates temporary SQL functions; Spark inlines their bodies into the
calling query, so nothing is opaque to the optimizer. SQL functions cannot be
overloaded, hence ``linear_interpolate_ts`` next to ``linear_interpolate``. FIRST and
LAST that skip NULLs are Spark's own ``first(x, true)`` and ``last(x, true)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gapweave.functions.scalar import linear_interpolate_sql
from gapweave.functions.time import epoch_micros_sql
from gapweave.operators.fill import SUB_SLICE_US
from gapweave.operators.slices import BLOCK_SLICES

_SECONDS = "{} / 1e6D"


# Function names, parameter names and result columns are fixed values: users' SQL names them.
def _scalar_functions() -> dict[str, str]:
    start, end, t = (epoch_micros_sql(n) for n in ("start_t", "end_t", "timestamp_t"))
    x, x0, x1 = (_SECONDS.format(epoch_micros_sql(n)) for n in ("x_i", "x_0", "x_1"))
    line = linear_interpolate_sql("x_i", "x_0", "y_0", "x_1", "y_1", "error")
    line_ts = linear_interpolate_sql(f"({x})", f"({x0})", "y_0", f"({x1})", "y_1", "error")
    return {
        "datediff_seconds(start_t TIMESTAMP_NTZ, end_t TIMESTAMP_NTZ)": f"({end} - {start}) / 1e6D",
        "timestamp_to_seconds(timestamp_t TIMESTAMP_NTZ)": _SECONDS.format(t),
        "linear_interpolate(x_i DOUBLE, x_0 DOUBLE, y_0 DOUBLE, x_1 DOUBLE, y_1 DOUBLE)": line,
        "linear_interpolate_ts(x_i TIMESTAMP_NTZ, x_0 TIMESTAMP_NTZ, y_0 DOUBLE, "
        "x_1 TIMESTAMP_NTZ, y_1 DOUBLE)": line_ts,
    }


# One station's readings are combined by instant, filled along the line between the known ones
# around them, and summarised per slice; the empty slices get the line between the slices
# around them. The known readings around an instant are looked for in four steps: among the instants of
# the same 16 seconds of its slice, then among such parts of the slice, the slices of a block and the
# blocks, by the first and last known reading of each. A window never spans more than one step, so neither
# a slice of very many readings nor a long range meets in one task.
_INTERPOLATE = """
WITH bounds AS (
  SELECT step, first, CAST(floor((stop - first) / step) AS BIGINT) AS many,
         IF(first_us % (step * 1000000L) = 0, 0L,
            CAST(raise_error('start is not a multiple of step counted from 1970-01-01') AS BIGINT)) AS checked
  FROM (SELECT CAST(slice_t AS BIGINT) AS step, {start_us} AS first_us, {start_us} div 1000000L AS first,
               {end_us} div 1000000L AS stop)
),
readings AS (
  SELECT CAST(rint({us} / 1e6D) AS BIGINT) div step * step AS s, {us} AS us,
         CAST(temperature AS DOUBLE) AS v, first, step
  FROM {table} CROSS JOIN bounds
  WHERE wban = wban_p AND datetime IS NOT NULL
    AND datetime BETWEEN start_t - slice_t - INTERVAL '1' SECOND AND end_t + slice_t + INTERVAL '1' SECOND
),
instants AS (
  SELECT (s - first) div step div {block}L AS b, s, us,
         max_by(v, CASE WHEN v IS NOT NULL THEN shiftrightunsigned(xxhash64(v), 2) END) AS y,
         min(v) AS lo, max(v) AS hi, sum(v) AS total, count(v) AS known, count_if(v IS NULL) AS missing
  FROM readings WHERE s BETWEEN first AND {end_us} div 1000000L GROUP BY s, us, first, step
),
near AS (
  SELECT *, last(x, true) OVER up AS px, last(y, true) OVER up AS py,
         last(x, true) OVER down AS nx, last(y, true) OVER down AS ny
  FROM (SELECT *, CASE WHEN y IS NOT NULL THEN us END AS x, {part} AS part FROM instants)
  WINDOW up AS (PARTITION BY b, s, part ORDER BY us), down AS (PARTITION BY b, s, part ORDER BY us DESC)
),
parts AS (
  SELECT b, s, part, min(x) AS xf, min_by(y, x) AS yf, max(x) AS xl, max_by(y, x) AS yl
  FROM (SELECT b, s, {part} AS part, y, CASE WHEN y IS NOT NULL THEN us END AS x FROM instants) GROUP BY b, s, part
),
near_parts AS (
  SELECT b, s, part, last(xl, true) OVER before AS px, last(yl, true) OVER before AS py,
         last(xf, true) OVER after AS nx, last(yf, true) OVER after AS ny
  FROM parts
  WINDOW before AS (PARTITION BY b, s ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY b, s ORDER BY part DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
slices AS (
  SELECT b, s, min(xf) AS xf, min_by(yf, xf) AS yf, max(xl) AS xl, max_by(yl, xl) AS yl FROM parts GROUP BY b, s
),
near_slices AS (
  SELECT b, s, last(xl, true) OVER before AS px, last(yl, true) OVER before AS py,
         last(xf, true) OVER after AS nx, last(yf, true) OVER after AS ny
  FROM slices
  WINDOW before AS (PARTITION BY b ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY b ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
edges AS (
  SELECT b, min(xf) AS xf, min_by(yf, xf) AS yf, max(xl) AS xl, max_by(yl, xl) AS yl FROM slices GROUP BY b
),
blocks AS (
  SELECT c.b, c.step, c.first, c.many,
         last(xl, true) OVER before AS bpx, last(yl, true) OVER before AS bpy,
         last(xf, true) OVER after AS bnx, last(yf, true) OVER after AS bny
  FROM (SELECT step, first, many + checked AS many,
               explode(sequence(0L, (many + checked) div {block}L)) AS b FROM bounds WHERE many >= 0) c
  LEFT JOIN edges e ON c.b = e.b
  WINDOW before AS (ORDER BY c.b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY c.b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
around AS (
  SELECT p.b, p.s, p.part, coalesce(p.px, l.px, k.bpx) AS ppx, coalesce(p.py, l.py, k.bpy) AS ppy,
         coalesce(p.nx, l.nx, k.bnx) AS pnx, coalesce(p.ny, l.ny, k.bny) AS pny
  FROM near_parts p JOIN near_slices l ON p.b = l.b AND p.s = l.s JOIN blocks k ON p.b = k.b
),
filled AS (
  SELECT n.*, CASE WHEN missing > 0 THEN {inner} END AS w
  FROM (SELECT n.*, coalesce(px, ppx) AS x0, coalesce(py, ppy) AS y0, coalesce(nx, pnx) AS x1, coalesce(ny, pny) AS y1
        FROM near n JOIN around a ON n.b = a.b AND n.s = a.s AND n.part = a.part) n
),
occupied AS (
  SELECT b, s, least(min(lo), min(w)) AS lo, greatest(max(hi), max(w)) AS hi,
         (coalesce(sum(total), 0D) + coalesce(sum(w * missing), 0D))
           / nullif(sum(known) + sum(IF(w IS NULL, 0L, missing)), 0L) AS mean,
         min(x) AS xf, min_by(y, x) AS yf, max(x) AS xl, max_by(y, x) AS yl
  FROM filled GROUP BY b, s
),
dense AS (
  SELECT b, bpx, bpy, bnx, bny,
         explode(sequence(first + b * {block}L * step,
                          first + least((b + 1L) * {block}L - 1L, many) * step, step)) AS s
  FROM (SELECT /*+ REPARTITION({partitions}, b) */ * FROM blocks)
),
carried AS (
  SELECT d.b, d.s, o.s IS NOT NULL AS own, lo, hi, mean,
         coalesce(last(xl, true) OVER up, bpx) AS x0, coalesce(last(yl, true) OVER up, bpy) AS y0,
         coalesce(last(xf, true) OVER down, bnx) AS x1, coalesce(last(yf, true) OVER down, bny) AS y1
  FROM dense d LEFT JOIN occupied o ON d.b = o.b AND d.s = o.s
  WINDOW up AS (PARTITION BY d.b ORDER BY d.s), down AS (PARTITION BY d.b ORDER BY d.s DESC)
),
lined AS (SELECT s, own, lo, hi, mean, CASE WHEN NOT own THEN {line} END AS line FROM carried)
SELECT wban_p, timestampadd(SECOND, s, {epoch}),
       IF(own, lo, line), IF(own, hi, line), IF(own, mean, line) FROM lined
"""


def register(spark: SparkSession, weather_table: str | None = None) -> list[str]:
    """Create the temporary functions; returns their names.

    With ``weather_table``, a table or view with wban, datetime and temperature, also
    the table function ``interpolate_temperature(wban_p, start_t, end_t, slice_t)``
    for one station: the rows of ``interpolate_series`` for that station, an unaligned start included,
    which is an error.
    """
    names = []
    for signature, body in _scalar_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS DOUBLE RETURN {body}")
        names.append(signature.split("(")[0])
    if weather_table:
        between = [f"{c} / 1e6D" if c[0] == "x" else c for c in ("x0", "y0", "x1", "y1")]
        line = linear_interpolate_sql("CAST(s AS DOUBLE)", *between, "error")
        body = _INTERPOLATE.format(
            us=epoch_micros_sql("datetime"),
            start_us=epoch_micros_sql("start_t"),
            end_us=epoch_micros_sql("end_t"),
            table=weather_table,
            epoch="TIMESTAMP_NTZ'1970-01-01'",
            block=BLOCK_SLICES,
            part=f"us div {SUB_SLICE_US}L",
            partitions=spark.conf.get("spark.sql.shuffle.partitions"),
            inner=line,
            line=line,
        )
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION interpolate_temperature("
            "wban_p STRING, start_t TIMESTAMP_NTZ, end_t TIMESTAMP_NTZ, slice_t INTERVAL DAY TO SECOND) "
            "RETURNS TABLE(r_wban STRING, r_slice TIMESTAMP_NTZ, min_temp DOUBLE, max_temp DOUBLE, avg_temp DOUBLE) "
            f"RETURN {body}"
        )
        names.append("interpolate_temperature")
    return names
