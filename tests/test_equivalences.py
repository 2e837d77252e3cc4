"""Optimisations keep results: pushed-down windows, grid arithmetic."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tephra.functions.events import grid_index
from tephra.operators import marts, serving, staging
from tephra.sources import testdata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stg(spark):
    ev = testdata.load(spark, SF, "events")
    return staging.stg_fires(testdata.fires_table(ev)), staging.stg_quakes(testdata.quakes_table(ev))


@pytest.mark.parametrize(
    "as_of", ["2024-01-02 00:00:00", "2024-01-15 13:30:00", "2024-01-31 00:00:00", "2024-03-01 00:00:00"]
)
def test_pushed_down_realtime_card_equals_full_one(spark, stg, as_of):
    f, q = stg
    full = serving.realtime_summary(marts.combined_events(f, q), as_of=as_of).first().asDict()
    pruned = serving.realtime_summary_from_staging(f, q, as_of=as_of).first().asDict()
    assert pruned == full


def test_date_window_equals_filtering_the_result(spark, stg):
    f, q = stg
    day = "2024-01-20"
    windowed = marts.combined_events(f, q, date_from=day)
    filtered = marts.combined_events(f, q).where(F.col("event_date") >= F.lit(day).cast("date"))
    assert windowed.exceptAll(filtered).count() == 0 and filtered.exceptAll(windowed).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-180, max_value=180, allow_nan=False), min_size=1, max_size=50))
def test_grid_index_matches_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select("x", grid_index(F.col("x")).alias("t"), grid_index(F.col("x"), rounding="floor").alias("f")).collect()
    for r in rows:
        assert r.t == math.trunc(r.x / 0.22)
        assert r.f == math.floor(r.x / 0.22)


def test_realtime_card_default_clock_and_datetime_as_of(spark, stg):
    import datetime as dt

    f, q = stg
    now = serving.realtime_summary_from_staging(f, q).first()
    # The fixture ends in January 2024: nothing is recent "now".
    assert (now.fires_7d, now.earthquakes_7d, now.alert_status) == (0, 0, "NORMAL")
    assert now.last_updated.year >= 2025
    as_dt = serving.realtime_summary_from_staging(f, q, as_of=dt.datetime(2024, 1, 31)).first()
    as_str = serving.realtime_summary_from_staging(f, q, as_of="2024-01-31 00:00:00").first()
    assert as_dt == as_str


def test_bounded_date_window_equals_filtering_the_result(spark, stg):
    f, q = stg
    lo, hi = "2024-01-10", "2024-01-12"
    for build in (lambda **kw: marts.fire_summary(f, ordered=False, **kw), lambda **kw: marts.quake_summary(q, ordered=False, **kw)):
        windowed = build(date_from=lo, date_to=hi)
        filtered = build().where(F.col("event_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
        assert windowed.count() > 0
        assert windowed.exceptAll(filtered).count() == 0 and filtered.exceptAll(windowed).count() == 0
