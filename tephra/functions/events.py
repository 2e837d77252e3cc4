"""Column expressions shared by the parsers: time stamps, ids, grid cells.

All of them are null-safe built-ins: a bad value gives NULL, never an
error, so one malformed line cannot fail a micro-batch under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CELL_DEGREES = 0.22


def acq_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def hhmm(acq_time: Column) -> Column:
    """Four-digit HHmm; shorter values are zero-padded, longer ones truncated."""
    return F.lpad(acq_time, 4, "0")


def acq_timestamp(acq_date_col: Column, acq_time: Column) -> Column:
    text = F.concat_ws(" ", acq_date_col.cast("string"), hhmm(acq_time))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HHmm"))


def fire_event_id(
    satellite: Column, acq_date_col: Column, acq_time: Column, lat: Column, lon: Column
) -> Column:
    """``satellite_date_HHmm_lat_lon``; NULL parts are skipped, as in the feed."""
    return F.concat_ws(
        "_", satellite, acq_date_col.cast("string"), hhmm(acq_time), lat, lon
    )


def grid_index(x: Column, size: float = DEFAULT_CELL_DEGREES, rounding: str = "trunc") -> Column:
    """Cell index of one axis. ``trunc`` (the feed's behaviour) makes cell 0
    twice as wide; ``floor`` gives equal cells on both sides of zero."""
    q = x / F.lit(size)
    if rounding == "floor":
        q = F.floor(q)
    elif rounding != "trunc":
        raise ValueError(f"rounding must be 'trunc' or 'floor', not {rounding!r}")
    return q.try_cast("int")


def grid_cell(
    lat: Column,
    lon: Column,
    day: Column,
    size: float = DEFAULT_CELL_DEGREES,
    rounding: str = "trunc",
) -> Column:
    return F.concat_ws(
        "_",
        grid_index(lat, size, rounding).cast("string"),
        grid_index(lon, size, rounding).cast("string"),
        day.cast("string"),
    )


# Year 10000 in epoch milliseconds: beyond it the feed value is garbage.
MAX_EPOCH_MILLIS = 253402300800000


def epoch_millis_to_seconds_ts(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp truncated to whole seconds
    (sub-second digits are dropped); out-of-range values give NULL."""
    ok = (millis >= 0) & (millis < F.lit(MAX_EPOCH_MILLIS))
    return F.when(ok, F.timestamp_seconds(F.floor(millis / F.lit(1000))))
