"""Marts: daily fire summary, hourly quake summary, fire clusters, combined events.

All are single hash aggregations (partial aggregate before the shuffle,
final after it), so a hot group costs one row per map task on the wire.
Thresholds are tested on the unrounded averages. The summaries round what
they show; clusters and combined events keep the raw averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.functions import rules
from tephra.functions.numeric import round_half_up

COMBINED_COLUMNS = [
    "latitude",
    "longitude",
    "event_type",
    "intensity_measure",
    "event_time",
    "event_date",
    "severity_level",
]


def _date_window(df: DataFrame, part_col: str | None, date_from, date_to) -> DataFrame:
    """Keep events whose UTC day is in ``[date_from, date_to]``.

    The test on the partition column prunes files; the test on the event
    time keeps the result exact (rows without a time have no day).
    """
    day = F.to_date("event_time")
    if date_from is not None:
        lo = as_column(date_from).cast("date")
        if part_col:
            df = df.where(F.col(part_col) >= lo)
        df = df.where(day >= lo)
    if date_to is not None:
        hi = as_column(date_to).cast("date")
        if part_col:
            df = df.where(F.col(part_col) <= hi)
        df = df.where(day <= hi)
    return df


def _part(df: DataFrame, name: str) -> str | None:
    return name if name in df.columns else None


def fire_summary_columns(n: Column, avg_b: Column, max_b: Column, avg_frp: Column, max_frp: Column) -> list[Column]:
    """What the fire summary shows of a group's statistics."""
    return [
        n.alias("fire_count"),
        round_half_up(avg_b, 2).alias("avg_brightness"),
        max_b.alias("max_brightness"),
        round_half_up(avg_frp, 2).alias("avg_frp"),
        max_frp.alias("max_frp"),
        rules.classify(
            avg_b, rules.FIRE_INTENSITY_CATEGORY, rules.FIRE_INTENSITY_CATEGORY_DEFAULT
        ).alias("fire_intensity_category"),
    ]


def quake_summary_columns(
    n: Column, avg_m: Column, max_m: Column, min_m: Column, avg_d: Column, max_d: Column
) -> list[Column]:
    """What the earthquake summary shows of a group's statistics."""
    return [
        n.alias("earthquake_count"),
        round_half_up(avg_m, 2).alias("avg_magnitude"),
        max_m.alias("max_magnitude"),
        min_m.alias("min_magnitude"),
        round_half_up(avg_d, 2).alias("avg_depth"),
        max_d.alias("max_depth"),
    ]


def fire_cluster_columns(avg_lat: Column, avg_lon: Column, avg_b: Column, last: Column) -> list[Column]:
    """What a fire cluster shows of its statistics."""
    return [
        avg_lat.alias("latitude"),
        avg_lon.alias("longitude"),
        F.lit("fire").alias("event_type"),
        avg_b.alias("intensity_measure"),
        last.alias("event_time"),
        rules.classify(
            avg_b, rules.FIRE_CLUSTER_SEVERITY, rules.EVENT_SEVERITY_DEFAULT
        ).alias("severity_level"),
    ]


def fire_summary(
    stg: DataFrame, date_from=None, date_to=None, ordered: bool = True
) -> DataFrame:
    """Per (day, satellite, confidence): count, brightness and power statistics."""
    stg = _date_window(stg, _part(stg, "acq_date"), date_from, date_to)
    out = stg.groupBy(
        F.to_date("event_time").alias("event_date"), "satellite", "confidence"
    ).agg(
        *fire_summary_columns(
            F.count(F.lit(1)),
            F.avg("bright_ti4"),
            F.max("bright_ti4"),
            F.avg("fire_radioactive_power"),
            F.max("fire_radioactive_power"),
        )
    )
    return out.orderBy(F.col("event_date").desc()) if ordered else out


def quake_summary(
    stg: DataFrame, date_from=None, date_to=None, ordered: bool = True
) -> DataFrame:
    """Per (day, hour): count and magnitude/depth statistics."""
    stg = _date_window(stg, _part(stg, "event_date"), date_from, date_to)
    out = stg.groupBy(
        F.to_date("event_time").alias("event_date"),
        F.hour("event_time").cast("int").alias("hour"),
    ).agg(
        *quake_summary_columns(
            F.count(F.lit(1)),
            F.avg("magnitude"),
            F.max("magnitude"),
            F.min("magnitude"),
            F.avg("depth"),
            F.max("depth"),
        )
    )
    if ordered:
        out = out.orderBy(F.col("event_date").desc(), F.col("hour").desc())
    return out


def fire_clusters(stg: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """One row per (grid cell, day): centroid, mean brightness, last time, severity.

    ``event_date`` is the grouping day, which equals the day of the last
    time in the group; being a grouping key, a filter on it is pushed
    below the aggregate (and on to the partition column of the scan).
    """
    stg = _date_window(stg, _part(stg, "acq_date"), date_from, date_to)
    return stg.groupBy("cluster_id", F.to_date("event_time").alias("event_date")).agg(
        *fire_cluster_columns(F.avg("latitude"), F.avg("longitude"), F.avg("bright_ti4"), F.max("event_time"))
    ).select(*COMBINED_COLUMNS)


def quake_events(stg: DataFrame, date_from=None, date_to=None) -> DataFrame:
    stg = _date_window(stg, _part(stg, "event_date"), date_from, date_to)
    mag = F.col("magnitude")
    return stg.select(
        "latitude",
        "longitude",
        F.lit("earthquake").alias("event_type"),
        mag.alias("intensity_measure"),
        "event_time",
        F.to_date("event_time").alias("event_date"),
        rules.classify(mag, rules.QUAKE_SEVERITY, rules.EVENT_SEVERITY_DEFAULT).alias(
            "severity_level"
        ),
    )


def combined_events(
    stg_fires: DataFrame, stg_quakes: DataFrame, date_from=None, date_to=None
) -> DataFrame:
    """Set union of fire clusters and individual earthquakes."""
    return (
        fire_clusters(stg_fires, date_from, date_to)
        .unionByName(quake_events(stg_quakes, date_from, date_to))
        .distinct()
    )


def build_marts(stg_f: DataFrame, stg_q: DataFrame, date_from=None, date_to=None) -> dict:
    """All marts over the two staging relations (what the hourly job rebuilds).

    Unordered: these are written as tables, which keep no row order.
    """
    return {
        "fire_summary": fire_summary(stg_f, date_from, date_to, ordered=False),
        "earthquake_summary": quake_summary(stg_q, date_from, date_to, ordered=False),
        "combined_events": combined_events(stg_f, stg_q, date_from, date_to),
    }


def as_column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
