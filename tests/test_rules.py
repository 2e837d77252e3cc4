"""Classification thresholds: values exactly on every boundary, and NULL."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tephra.functions import rules
from tephra.operators import marts, serving


def _classify(spark, values, table, default):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", rules.classify(F.col("x"), table, default).alias("c"))
    return {r.x: r.c for r in out.collect() if r.x is not None}, [
        r.c for r in out.collect() if r.x is None
    ]


@pytest.mark.parametrize(
    "table,default,cases",
    [
        (rules.FIRE_INTENSITY_CATEGORY, "low", {400.0: "severe", 399.99: "moderate", 350.0: "moderate", 349.9: "low"}),
        (rules.FIRE_CLUSTER_SEVERITY, "moderate", {400.0: "severe", 399.9: "moderate"}),
        (rules.QUAKE_SEVERITY, "moderate", {6.0: "severe", 5.9: "moderate"}),
        (
            rules.FIRE_MAP_CATEGORY,
            "Low Fire",
            {400.0: "Severe Fire", 400.1: "Extreme Fire", 350.0: "Moderate Fire", 320.0: "Low Fire", 320.1: "Moderate Fire"},
        ),
        (
            rules.QUAKE_MAP_CATEGORY,
            "Minor Earthquake",
            {7.0: "Major Earthquake", 5.5: "Strong Earthquake", 4.0: "Moderate Earthquake", 2.5: "Light Earthquake", 2.4: "Minor Earthquake"},
        ),
        (rules.FIRE_MAP_COLOR, "#FFA500", {400.0: "#FF0000", 401.0: "#8B0000", 350.0: "#FF6600", 320.0: "#FFA500"}),
        (
            rules.QUAKE_MAP_COLOR,
            "#ADD8E6",
            {6.0: "#4B0082", 5.0: "#0000FF", 4.0: "#1E90FF", 3.0: "#87CEEB", 2.9: "#ADD8E6"},
        ),
        (rules.FIRE_POWER_SEVERITY, "Low", {500.0: "Severe", 500.5: "Extreme", 200.0: "Moderate", 50.0: "Low", 50.1: "Moderate"}),
        (
            rules.QUAKE_ACTIVITY,
            "Minor Activity",
            {6.0: "Significant Activity", 4.5: "Moderate Activity", 3.0: "Light Activity", 2.99: "Minor Activity"},
        ),
        (rules.QUAKE_DEPTH, "Deep", {70.0: "Shallow", 70.01: "Intermediate", 300.0: "Intermediate", 300.01: "Deep"}),
    ],
)
def test_thresholds_and_null(spark, table, default, cases):
    got, nulls = _classify(spark, list(cases) + [None], table, default)
    assert got == cases
    assert nulls == [default]


def test_confidence_lookup(spark):
    df = spark.createDataFrame([("h",), ("n",), ("l",), ("x",), (None,)], "c string")
    out = [r[0] for r in df.select(rules.lookup(F.col("c"), rules.CONFIDENCE_LEVEL, "Unknown")).collect()]
    assert out == ["High", "Nominal", "Low", "Unknown", "Unknown"]


def _combined(spark, rows):
    return spark.createDataFrame(
        rows,
        "latitude double, longitude double, event_type string, intensity_measure double, "
        "event_time timestamp, event_date date, severity_level string",
    )


def test_map_events_bubble_tooltip_unknown_type(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    d = t.date()
    df = _combined(
        spark,
        [
            (1.0, 2.0, "fire", 299.0, t, d, "moderate"),
            (1.0, 2.0, "fire", 302.0, t, d, "moderate"),
            (1.0, 2.0, "fire", 500.0, t, d, "severe"),
            (1.0, 2.0, "fire", 501.0, t, d, "severe"),
            (1.0, 2.0, "fire", None, t, d, "moderate"),
            (1.0, 2.0, "earthquake", 5.0, t, d, "moderate"),
            (1.0, 2.0, "volcano", 5.0, t, d, "moderate"),
        ],
    )
    out = serving.map_events(df).collect()
    bubbles = [r.bubble_size for r in out]
    assert bubbles[:5] == [1.0, 1.0, 100.0, 100.0, None]
    assert bubbles[5] == 32.0
    assert out[5].tooltip_text == "Magnitude: 5.0 | Time: 2024-01-02 03:04 UTC"
    assert out[0].tooltip_text == "Fire Intensity: 299.0 K | Time: 2024-01-02 03:04 UTC"
    assert out[0].latlong == "1,2"
    unknown = out[6]
    assert (unknown.intensity_category, unknown.map_color, unknown.bubble_size, unknown.tooltip_text) == (
        None,
        None,
        None,
        None,
    )


def test_realtime_summary_empty_input(spark):
    out = serving.realtime_summary(_combined(spark, []), as_of="2024-01-31 00:00:00").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.fires_24h, r.earthquakes_24h, r.fires_7d, r.earthquakes_7d) == (0, 0, 0, 0)
    assert r.max_fire_intensity_24h is None and r.max_earthquake_magnitude_24h is None
    assert r.alert_status == "NORMAL"
    assert r.last_updated == dt.datetime(2024, 1, 31)


@pytest.mark.parametrize(
    "quake,fire,n,expected",
    [
        (6.0, 500.0, 101, "CRITICAL"),
        (None, 500.0, 101, "HIGH"),
        (None, None, 101, "ELEVATED"),
        (None, None, 100, "NORMAL"),
        (5.99, 400.0, 100, "NORMAL"),
    ],
)
def test_alert_priority(spark, quake, fire, n, expected):
    t = dt.datetime(2024, 1, 30, 12)
    d = t.date()
    rows = [(0.0, 0.0, "fire", 300.0, t, d, "moderate")] * (n - (quake is not None) - (fire is not None))
    if quake is not None:
        rows.append((0.0, 0.0, "earthquake", quake, t, d, "moderate"))
    if fire is not None:
        rows.append((0.0, 0.0, "fire", fire, t, d, "moderate"))
    # An old event (outside 24 h, inside 7 days) only moves the 7-day counters.
    rows.append((0.0, 0.0, "earthquake", 9.0, dt.datetime(2024, 1, 26), dt.date(2024, 1, 26), "severe"))
    r = serving.realtime_summary(_combined(spark, rows), as_of="2024-01-31 00:00:00").first()
    assert r.alert_status == expected
    assert r.earthquakes_7d == r.earthquakes_24h + 1


def test_fire_summary_category_uses_unrounded_average(spark):
    # 399.996 rounds to 400.0 but is below 400: the category stays "moderate".
    stg = spark.createDataFrame(
        [(1.0, 1.0, 399.996, dt.datetime(2024, 1, 1, 1), "N", "h", 1.0, "D", "fire", "c")],
        "latitude double, longitude double, bright_ti4 double, event_time timestamp, satellite string, "
        "confidence string, fire_radioactive_power double, daynight string, event_type string, cluster_id string",
    )
    r = marts.fire_summary(stg).first()
    assert r.avg_brightness == 400.0
    assert r.fire_intensity_category == "moderate"


def test_fire_summary_null_time_group_is_kept(spark):
    stg = spark.createDataFrame(
        [(1.0, 1.0, 300.0, None, "N", "h", 1.0, "D", "fire", "c")],
        "latitude double, longitude double, bright_ti4 double, event_time timestamp, satellite string, "
        "confidence string, fire_radioactive_power double, daynight string, event_type string, cluster_id string",
    )
    r = marts.fire_summary(stg).collect()
    assert len(r) == 1 and r[0].event_date is None and r[0].fire_count == 1


def _stage(spark, *rows):
    ddl = (
        "latitude double, longitude double, bright_ti4 double, event_time timestamp, satellite string, "
        "confidence string, fire_radioactive_power double, daynight string, event_type string, cluster_id string"
    )
    t = dt.datetime(2024, 1, 1, 5)
    return spark.createDataFrame([(lat, 1.0, b, t, "N", "h", 1.0, "D", "fire", cell) for lat, b, cell in rows], ddl)


def test_thresholds_see_unrounded_averages(spark):
    eps = 1e-9
    stg = _stage(spark, (1.0, 400 - eps, "a"), (1.0, 400.0, "b"), (1.0, 400 + eps, "c"))
    got = {r.intensity_measure: r.severity_level for r in marts.fire_clusters(stg).collect()}
    assert got == {400 - eps: "moderate", 400.0: "severe", 400 + eps: "severe"}
    cats = {r.intensity_measure: r.intensity_category for r in serving.map_events(marts.fire_clusters(stg)).collect()}
    assert cats == {400 - eps: "Severe Fire", 400.0: "Severe Fire", 400 + eps: "Extreme Fire"}
    below = marts.fire_summary(_stage(spark, (1.0, 400 - eps, "a"))).first()
    assert (below.fire_intensity_category, below.avg_brightness) == ("moderate", 400.0)


def test_wild_values_raise_nothing(spark):
    stg = _stage(spark, (5000.0, 1e21, "a"), (0.0000125, 330.0, "b"), (-0.0, 330.0, "c"))
    assert marts.fire_summary(stg).first().max_brightness == 1e21
    rows = {r.latitude: r for r in serving.map_events(marts.fire_clusters(stg)).collect()}
    assert rows[5000.0].latlong == "5000,1" and rows[5000.0].bubble_size == 100.0
    assert rows[0.0000125].latlong == "0.0000125,1" and rows[0.0].latlong == "0,1"
    assert serving.fire_metrics(marts.fire_summary(stg)).first().max_brightness == 1e21
