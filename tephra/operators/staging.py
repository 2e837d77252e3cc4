"""Staging relations over the stored event tables.

Both keep the partition column of the stored table (``acq_date`` /
``event_date``) next to the reference columns, so a date filter placed on
a staging relation still prunes partitions of the scan. Use
:func:`reference_columns` to get exactly the reference's column list.
``carry`` names further columns of the stored table to keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STG_FIRES_COLUMNS = [
    "latitude",
    "longitude",
    "bright_ti4",
    "event_time",
    "satellite",
    "confidence",
    "fire_radioactive_power",
    "daynight",
    "event_type",
    "cluster_id",
]

STG_QUAKES_COLUMNS = [
    "magnitude",
    "place",
    "event_time",
    "longitude",
    "latitude",
    "depth",
    "event_type",
    "cluster_id",
]


def _has_coords(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def stg_fires(fires: DataFrame, keep_partition: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    cols = [
        "latitude",
        "longitude",
        "bright_ti4",
        F.col("event_timestamp").alias("event_time"),
        "satellite",
        "confidence",
        F.col("frp").alias("fire_radioactive_power"),
        "daynight",
        "event_type",
        "cluster_id",
    ]
    if keep_partition:
        cols.append("acq_date")
    return _has_coords(fires).select(*cols, *carry)


def stg_quakes(quakes: DataFrame, keep_partition: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    cols = [
        "magnitude",
        "place",
        F.col("event_timestamp").alias("event_time"),
        "longitude",
        "latitude",
        "depth",
        "event_type",
        F.lit(None).cast("string").alias("cluster_id"),
    ]
    if keep_partition:
        cols.append("event_date")
    return _has_coords(quakes).select(*cols, *carry)


def reference_columns(stg: DataFrame) -> DataFrame:
    """Drop the carried partition column again."""
    return stg.drop("acq_date", "event_date")
