"""Declared schemas of the raw feeds and of the stored event tables, as Spark DDL."""

from __future__ import annotations

# Column order of one fire CSV line, as the upstream feed emits it.
FIRE_CSV_TYPES = {
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "bright_ti4": "DOUBLE",
    "scan": "DOUBLE",
    "track": "DOUBLE",
    "acq_date": "STRING",
    "acq_time": "STRING",
    "satellite": "STRING",
    "instrument": "STRING",
    "confidence": "STRING",
    "version": "STRING",
    "bright_ti5": "DOUBLE",
    "frp": "DOUBLE",
    "daynight": "STRING",
}
FIRE_CSV = ", ".join(f"{name} {kind}" for name, kind in FIRE_CSV_TYPES.items())

FIRE_CSV_COLUMNS = list(FIRE_CSV_TYPES)

# One feature of a GeoJSON earthquake collection.
QUAKE_FEATURE = """
    properties STRUCT<
        mag: DOUBLE,
        place: STRING,
        time: BIGINT,
        updated: BIGINT,
        tz: INT,
        url: STRING,
        detail: STRING,
        felt: INT,
        cdi: DOUBLE,
        mmi: DOUBLE,
        alert: STRING,
        status: STRING,
        tsunami: INT,
        sig: INT,
        net: STRING,
        code: STRING,
        ids: STRING,
        sources: STRING,
        types: STRING,
        nst: INT,
        dmin: DOUBLE,
        rms: DOUBLE,
        gap: DOUBLE,
        magType: STRING,
        type: STRING,
        title: STRING
    >,
    geometry STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>,
    id STRING
"""

# Only the leaves the pipeline reads; the JSON parser skips everything else.
QUAKE_FEATURE_NARROW = """
    properties STRUCT<mag: DOUBLE, place: STRING, time: BIGINT>,
    geometry STRUCT<coordinates: ARRAY<DOUBLE>>,
    id STRING
"""

# A collection whose features stay text: each is parsed on its own, so a bad one costs no other.
QUAKE_COLLECTION = "type STRING, features ARRAY<STRING>"

# Column order of the stored tables.
FIRES_COLUMNS = [*FIRE_CSV_COLUMNS, "event_timestamp", "event_type", "event_id", "cluster_id"]

QUAKES_COLUMNS = [
    "magnitude",
    "place",
    "time",
    "longitude",
    "latitude",
    "depth",
    "event_id",
    "event_type",
    "event_timestamp",
    "event_date",
    "processed_at",
]
