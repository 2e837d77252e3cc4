"""Hand-written payloads through the fire CSV and quake GeoJSON parsers."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tephra.operators import parse

HEADER = (
    "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,"
    "instrument,confidence,version,bright_ti5,frp,daynight"
)


def fire_line(lat="0.5", lon="1.0", date="2024-01-01", time="7", sat="N"):
    return f"{lat},{lon},300.0,0.4,0.4,{date},{time},{sat},VIIRS,h,2.0NRT,290.0,1.5,D"


def fires(spark, *docs, **kw):
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    return parse.parse_fires(df, **kw)


def test_header_crlf_quotes_and_noise(spark):
    doc = HEADER + "\r\n" + '"0.5",1.0,300.0,0.4,0.4,2024-01-01,7,N,VIIRS,h,2.0NRT,290.0,1.5,D' + "\r\n" + "x" * 10
    out = fires(spark, doc, "", HEADER, None).collect()
    assert len(out) == 1
    r = out[0]
    assert r.latitude == 0.5 and r.acq_date == dt.date(2024, 1, 1)
    assert r.event_timestamp == dt.datetime(2024, 1, 1, 0, 7)
    assert r.event_id == "N_2024-01-01_0007_0.5_1.0"
    assert r.event_type == "fire"


def test_line_length_boundary(spark):
    # 10 characters are dropped, 11 are kept (and parse to a mostly NULL row).
    out = fires(spark, "a,b,c,d,ef", "a,b,c,d,efg").collect()
    assert len(out) == 1


@pytest.mark.parametrize(
    "acq_time,expected",
    [("7", "00:07"), ("007", "00:07"), ("0007", "00:07"), ("12345", "12:34")],
)
def test_acq_time_padding_and_truncation(spark, acq_time, expected):
    r = fires(spark, fire_line(time=acq_time)).first()
    assert r.event_timestamp.strftime("%H:%M") == expected


def test_bad_row_keeps_nulls(spark):
    r = fires(spark, "badrow,1,2,3,4,notadate,xx").first()
    assert r.latitude is None and r.acq_date is None and r.event_timestamp is None


def test_quoted_comma_shifts_columns(spark):
    line = '0.5,1.0,300.0,0.4,0.4,2024-01-01,7,"N,X",VIIRS,h,2.0NRT,290.0,1.5,D'
    r = fires(spark, line).first()
    assert r.satellite == "N" and r.instrument == "X"


@pytest.mark.parametrize(
    "v,trunc,floor",
    [(-0.1, 0, -1), (0.1, 0, 0), (-0.22, -1, -1), (0.22, 1, 1), (0.219, 0, 0)],
)
def test_grid_cells(spark, v, trunc, floor):
    line = fire_line(lat=str(v), lon=str(v))
    t = fires(spark, line).first().cluster_id
    f = fires(spark, line, rounding="floor").first().cluster_id
    assert t == f"{trunc}_{trunc}_2024-01-01"
    assert f == f"{floor}_{floor}_2024-01-01"


def test_null_satellite_shortens_id(spark):
    r = fires(spark, fire_line(sat="")).first()
    assert r.event_id == "2024-01-01_0007_0.5_1.0"


def test_split_fires_routes_rejects(spark):
    df = spark.createDataFrame(
        [(HEADER + "\n" + fire_line() + "\nbadrow,1,2,3,4,notadate,xx\n" + fire_line(date="2024-13-40"),)],
        "value string",
    )
    good, rej = parse.split_fires(df)
    assert good.count() == 1
    reasons = sorted(r.reason for r in rej.collect())
    assert reasons == ["bad_acq_date", "malformed_csv"]


def feature(fid, time, coords=(10.0, 20.0, 5.0), mag=4.2):
    return {
        "type": "Feature",
        "properties": {"mag": mag, "place": f"p{fid}", "time": time},
        "geometry": {"type": "Point", "coordinates": list(coords)},
        "id": str(fid),
    }


def quakes(spark, *docs):
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    return parse.parse_quakes(df)


def test_quake_times_and_short_coordinates(spark):
    doc = json.dumps(
        {
            "type": "FeatureCollection",
            "features": [
                feature(1, None),
                feature(2, 0),
                feature(3, -1),
                feature(4, 1704067199999, coords=(10.0, 20.0)),
            ],
        }
    )
    out = quakes(spark, doc).collect()
    assert len(out) == 1
    r = out[0]
    assert r.event_id == "4"
    assert r.event_timestamp == dt.datetime(2023, 12, 31, 23, 59, 59)
    assert r.event_date == dt.date(2023, 12, 31)
    assert (r.longitude, r.latitude, r.depth) == (10.0, 20.0, None)


def test_malformed_and_empty_documents(spark):
    empty = json.dumps({"type": "FeatureCollection", "features": []})
    assert quakes(spark, '{"type": "FeatureColl', empty, None).count() == 0
    df = spark.createDataFrame([('{"type": "FeatureColl',), (empty,)], "value string")
    reasons = sorted(r.reason for r in parse.quake_rejects(df).collect())
    assert reasons == ["malformed_json", "no_features"]


def test_wide_schema_gives_same_rows(spark):
    doc = json.dumps({"type": "FeatureCollection", "features": [feature(7, 1704067200000)]})
    df = spark.createDataFrame([(doc,)], "value string")
    narrow = parse.parse_quakes(df, processed_at=F.lit(None).cast("timestamp")).collect()
    wide = parse.parse_quakes(df, processed_at=F.lit(None).cast("timestamp"), narrow=False).collect()
    assert narrow == wide


def test_one_bad_field_costs_no_other_feature(spark):
    good, bad = feature(1, 1704067200000), feature(2, 1704067201000, mag="abc")
    doc = json.dumps({"type": "FeatureCollection", "features": [bad, good, feature(3, "soon")]})
    out = {r.event_id: r.magnitude for r in quakes(spark, doc).collect()}
    assert out == {"1": 4.2, "2": None}
    df = spark.createDataFrame([(doc,)], "value string")
    rejected = {json.loads(r.record)["id"]: r.reason for r in parse.quake_rejects(df).collect()}
    assert rejected == {"2": "bad_field", "3": "bad_time"}


def test_every_unusable_feature_is_a_reject(spark):
    huge = feature(4, 900000000000000000)
    nowhere = {**feature(5, 1704067200000), "geometry": None}
    doc = json.dumps({"features": [feature(1, None), feature(2, 0), feature(3, -5), huge, nowhere, None, feature(6, 4070908800000)]})
    df = spark.createDataFrame([(doc,), (None,)], "value string")
    latest = F.lit("2030-01-01").cast("timestamp")
    reasons = sorted(r.reason for r in parse.quake_rejects(df, latest).collect())
    assert reasons == ["bad_time"] * 3 + ["future_time", "missing_coordinates", "no_features", "time_out_of_range"]
    assert {r.event_id for r in quakes(spark, doc, None).collect()} == {"5", "6"}
