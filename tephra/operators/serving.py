"""Dashboard relations over the marts: map layer, fire and quake metrics,
and the realtime summary card.

The map and metrics relations are narrow projections (no shuffle). The
realtime summary is one global aggregate with conditional counters over
a single scan of the 7-day window: the two 7-day counts that the
original view took from separate sub-queries come out of the same pass.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.functions import rules
from tephra.functions.numeric import double_text, round_half_up


def _fire_bubble(x: Column) -> Column:
    raw = (x - F.lit(rules.FIRE_BUBBLE_OFFSET)) / F.lit(rules.FIRE_BUBBLE_DIVISOR)
    clamped = F.greatest(
        F.lit(rules.FIRE_BUBBLE_MIN).cast("double"),
        F.least(F.lit(rules.FIRE_BUBBLE_MAX).cast("double"), raw),
    )
    # GREATEST/LEAST skip NULLs in Spark; the dashboard semantics propagate them.
    return F.when(x.isNotNull(), clamped)


def map_events(combined: DataFrame) -> DataFrame:
    """Map layer: category, colour, bubble size and tooltip per event."""
    et = F.col("event_type")
    x = F.col("intensity_measure")
    category = rules.by_event_type(
        et,
        rules.classify(x, rules.FIRE_MAP_CATEGORY, rules.FIRE_MAP_CATEGORY_DEFAULT),
        rules.classify(x, rules.QUAKE_MAP_CATEGORY, rules.QUAKE_MAP_CATEGORY_DEFAULT),
    )
    color = rules.by_event_type(
        et,
        rules.classify(x, rules.FIRE_MAP_COLOR, rules.FIRE_MAP_COLOR_DEFAULT),
        rules.classify(x, rules.QUAKE_MAP_COLOR, rules.QUAKE_MAP_COLOR_DEFAULT),
    )
    bubble = rules.by_event_type(
        et, _fire_bubble(x), F.pow(F.lit(rules.QUAKE_BUBBLE_BASE), x)
    )
    x1 = round_half_up(x, 1).cast("string")
    label = rules.by_event_type(
        et,
        F.concat(F.lit("Fire Intensity: "), x1, F.lit(" K")),
        F.concat(F.lit("Magnitude: "), x1),
    )
    tooltip = F.concat(
        label,
        F.lit(" | Time: "),
        F.date_format("event_time", "yyyy-MM-dd HH:mm 'UTC'"),
    )
    latlong = F.concat(
        double_text(F.col("latitude")), F.lit(","), double_text(F.col("longitude"))
    )
    # The column names and the texts of this layer.
    return combined.select(
        "event_type",
        "intensity_measure",
        "event_time",
        "event_date",
        "severity_level",
        "latitude",
        "longitude",
        latlong.alias("latlong"),
        category.alias("intensity_category"),
        color.alias("map_color"),
        bubble.alias("bubble_size"),
        tooltip.alias("tooltip_text"),
    )


def fire_metrics(fire_summary: DataFrame) -> DataFrame:
    d = F.col("event_date")
    return fire_summary.select(
        "event_date",
        "satellite",
        "confidence",
        "fire_count",
        round_half_up(F.col("avg_brightness"), 1).alias("avg_brightness"),
        round_half_up(F.col("max_brightness"), 1).alias("max_brightness"),
        round_half_up(F.col("avg_frp"), 1).alias("avg_fire_power"),
        round_half_up(F.col("max_frp"), 1).alias("max_fire_power"),
        rules.lookup(
            F.col("confidence"), rules.CONFIDENCE_LEVEL, rules.CONFIDENCE_LEVEL_DEFAULT
        ).alias("confidence_level"),
        rules.classify(
            F.col("max_frp"), rules.FIRE_POWER_SEVERITY, rules.FIRE_POWER_SEVERITY_DEFAULT
        ).alias("severity_level"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def quake_metrics(quake_summary: DataFrame) -> DataFrame:
    return quake_summary.select(
        "event_date",
        "hour",
        "earthquake_count",
        round_half_up(F.col("avg_magnitude"), 2).alias("avg_magnitude"),
        round_half_up(F.col("max_magnitude"), 2).alias("max_magnitude"),
        round_half_up(F.col("min_magnitude"), 2).alias("min_magnitude"),
        round_half_up(F.col("avg_depth"), 1).alias("avg_depth_km"),
        round_half_up(F.col("max_depth"), 1).alias("max_depth_km"),
        rules.classify(
            F.col("max_magnitude"), rules.QUAKE_ACTIVITY, rules.QUAKE_ACTIVITY_DEFAULT
        ).alias("activity_level"),
        rules.classify(
            F.col("avg_depth"), rules.QUAKE_DEPTH, rules.QUAKE_DEPTH_DEFAULT
        ).alias("depth_category"),
    )


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp")


def window_start(as_of=None) -> Column:
    """First day that can hold an event of the 7-day window."""
    return F.to_date(_ts(as_of) - F.expr("INTERVAL 7 DAYS"))


def realtime_summary_from_staging(
    stg_fires: DataFrame, stg_quakes: DataFrame, as_of=None
) -> DataFrame:
    """The realtime card computed from the staging relations, reading only
    the days the 7-day window can touch (partition pruning on the stored
    tables) instead of rebuilding the combined events of all history."""
    from tephra.operators.marts import combined_events

    start = window_start(as_of)
    return realtime_summary(combined_events(stg_fires, stg_quakes, date_from=start), as_of)


def realtime_summary(combined: DataFrame, as_of=None) -> DataFrame:
    """Counters of the last 24 hours and 7 days as seen at ``as_of``
    (default: now). Always exactly one row."""
    now = _ts(as_of)
    since_7d = now - F.expr("INTERVAL 7 DAYS")
    since_24h = now - F.expr("INTERVAL 24 HOURS")
    window = combined.where(F.col("event_time") >= since_7d)
    if "event_date" in combined.columns:
        # Redundant with the time test (event_date is the UTC day of event_time)
        # but lets a date-partitioned input skip old partitions.
        window = window.where(F.col("event_date") >= F.to_date(since_7d))
    et, x, t = F.col("event_type"), F.col("intensity_measure"), F.col("event_time")
    recent = t >= since_24h
    is_fire = et == "fire"
    is_quake = et == "earthquake"
    max_fire = F.max(F.when(recent & is_fire, x))
    max_quake = F.max(F.when(recent & is_quake, x))
    n_recent = F.count_if(recent)
    alert = (
        F.when(max_quake >= rules.ALERT_QUAKE_FROM, F.lit("CRITICAL"))
        .when(max_fire > rules.ALERT_FIRE_ABOVE, F.lit("HIGH"))
        .when(n_recent > rules.ALERT_COUNT_ABOVE, F.lit("ELEVATED"))
        .otherwise(F.lit("NORMAL"))
    )
    return window.agg(
        F.count_if(recent & is_fire).alias("fires_24h"),
        F.count_if(recent & is_quake).alias("earthquakes_24h"),
        F.count_if(recent & is_fire & (x > rules.SEVERE_FIRE_ABOVE)).alias("severe_fires_24h"),
        F.count_if(recent & is_quake & (x >= rules.SIGNIFICANT_QUAKE_FROM)).alias(
            "significant_earthquakes_24h"
        ),
        F.count_if(is_fire).alias("fires_7d"),
        F.count_if(is_quake).alias("earthquakes_7d"),
        max_fire.alias("max_fire_intensity_24h"),
        max_quake.alias("max_earthquake_magnitude_24h"),
        alert.alias("alert_status"),
        now.alias("last_updated"),
    )


def realtime_sql(table: str, as_of: str | None = None) -> str:
    """The realtime card as SQL text over the stored map layer, for a catalog view.

    The same counters as :func:`realtime_summary`: one pass over the partitions that
    the 7-day window can touch, one row always.
    """
    now = "current_timestamp()" if as_of is None else f"TIMESTAMP '{as_of}'"
    quake_bound, fire_bound = rules.ALERT_QUAKE_FROM, rules.ALERT_FIRE_ABOVE
    counters = {
        "fires_24h": "recent AND fire",
        "earthquakes_24h": "recent AND quake",
        "severe_fires_24h": f"recent AND fire AND x > {rules.SEVERE_FIRE_ABOVE}",
        "significant_earthquakes_24h": f"recent AND quake AND x >= {rules.SIGNIFICANT_QUAKE_FROM}",
        "fires_7d": "fire",
        "earthquakes_7d": "quake",
    }
    counted = ", ".join(f"count_if({test}) AS {name}" for name, test in counters.items())
    return f"""
        SELECT {", ".join(counters)}, max_fire_intensity_24h, max_earthquake_magnitude_24h,
               CASE WHEN max_earthquake_magnitude_24h >= {quake_bound} THEN 'CRITICAL'
                    WHEN max_fire_intensity_24h > {fire_bound} THEN 'HIGH'
                    WHEN events_24h > {rules.ALERT_COUNT_ABOVE} THEN 'ELEVATED'
                    ELSE 'NORMAL' END AS alert_status,
               {now} AS last_updated
        FROM (
            SELECT {counted}, count_if(recent) AS events_24h,
                   max(x) FILTER (WHERE recent AND fire) AS max_fire_intensity_24h,
                   max(x) FILTER (WHERE recent AND quake) AS max_earthquake_magnitude_24h
            FROM (
                SELECT intensity_measure AS x, event_type = 'fire' AS fire, event_type = 'earthquake' AS quake,
                       event_time >= {now} - INTERVAL 24 HOURS AS recent
                FROM {table}
                WHERE event_time >= {now} - INTERVAL 7 DAYS AND event_date >= to_date({now} - INTERVAL 7 DAYS)
            )
        )"""
