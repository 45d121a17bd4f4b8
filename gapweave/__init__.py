"""Gap detection, resampling and gap filling for irregular time series on Spark."""

from gapweave.functions.scalar import (
    at_time,
    datediff_seconds,
    is_blank,
    linear_interpolate,
    linear_interpolate_ts,
    parse_datetime,
    parse_missing,
    timestamp_to_seconds,
    to_utc,
)
from gapweave.operators.carry import first_non_null, last_non_null
from gapweave.operators.fill import (
    align_to_series,
    fill_backward,
    fill_forward,
    fill_series,
    interpolate,
)
from gapweave.operators.gaps import find_gaps, previous_reading, previous_reading_rows
from gapweave.operators.resample import interpolate_series, quantile, resample
from gapweave.operators.slices import dense_series, slice_micros, time_slice
from gapweave.operators.stations import (
    assign_station_id,
    check_not_null,
    check_unique,
    dedupe_first,
    enrich_with_station,
    known_stations,
    new_stations,
    to_station_rows,
    upsert_stations,
    with_station_struct,
)
from gapweave.plans.gap_state import GapState
from gapweave.plans.ingest import ingest, load_stations, weather_rows
from gapweave.plans.resample_state import ResampleState
from gapweave.sources.files import read_hourly, read_stations, read_weather
from gapweave.sources.layout import read_weather_clustered, write_weather_clustered
from gapweave.sources.sinks import append_stations, append_weather_table, write_weather, write_weather_jdbc
from gapweave.sources.station_table import StationTable
from gapweave.streaming.ingest import stream_ingest
from gapweave.streaming.ledger import TakenFiles

__all__ = [
    "GapState",
    "ResampleState",
    "StationTable",
    "TakenFiles",
    "align_to_series",
    "append_stations",
    "append_weather_table",
    "assign_station_id",
    "at_time",
    "check_not_null",
    "check_unique",
    "datediff_seconds",
    "dedupe_first",
    "dense_series",
    "enrich_with_station",
    "fill_backward",
    "fill_forward",
    "fill_series",
    "find_gaps",
    "first_non_null",
    "ingest",
    "interpolate",
    "interpolate_series",
    "is_blank",
    "known_stations",
    "last_non_null",
    "linear_interpolate",
    "linear_interpolate_ts",
    "load_stations",
    "new_stations",
    "parse_datetime",
    "parse_missing",
    "previous_reading",
    "previous_reading_rows",
    "quantile",
    "read_hourly",
    "read_stations",
    "read_weather",
    "read_weather_clustered",
    "resample",
    "stream_ingest",
    "slice_micros",
    "time_slice",
    "timestamp_to_seconds",
    "to_station_rows",
    "to_utc",
    "upsert_stations",
    "weather_rows",
    "with_station_struct",
    "write_weather",
    "write_weather_clustered",
    "write_weather_jdbc",
]
