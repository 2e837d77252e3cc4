"""Properties from the test plan: idempotence and conservation laws."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tephra.operators import marts, parse, staging
from tephra.operators.dedup import dedup
from tephra.plans import export
from tephra.sinks.parquet import read_table
from tephra.sources import testdata
from tephra.sources.landed import land_messages, stream_messages
from tephra.streaming import pipelines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return testdata.load(spark, SF, "events")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_is_idempotent(spark, events):
    rows = parse.parse_fires(testdata.fire_payloads(events, resend=True))
    once = dedup(rows, ["event_id"], keep="first")
    assert _same(dedup(once, ["event_id"], keep="first"), once)
    assert once.count() == once.select("event_id").distinct().count()


def test_cluster_and_summary_counts_are_conserved(spark, events):
    stg = staging.stg_fires(testdata.fires_table(events))
    n = stg.count()
    per_cell = stg.groupBy("cluster_id", F.to_date("event_time")).count()
    assert per_cell.agg(F.sum("count")).first()[0] == n
    assert marts.fire_clusters(stg).count() == per_cell.count()
    assert marts.fire_summary(stg).agg(F.sum("fire_count")).first()[0] == n


def test_exports_are_idempotent(spark, events, scratch):
    stg_f = staging.stg_fires(testdata.fires_table(events))
    stg_q = staging.stg_quakes(testdata.quakes_table(events))
    m = {"fire_summary": marts.fire_summary(stg_f, ordered=False),
         "combined_events": marts.combined_events(stg_f, stg_q)}
    export.export_tables(spark, m, scratch)
    first = {t: read_table(spark, f"{scratch}/{t}").cache() for t in m}
    for df in first.values():
        df.count()
    export.export_tables(spark, m, scratch)
    for t in m:
        assert _same(read_table(spark, f"{scratch}/{t}"), first[t])
    # High-water-mark appends add nothing when nothing is new.
    log = export.export_tables(spark, {"fire_summary": m["fire_summary"]}, f"{scratch}/h", incremental="append_hwm")
    log2 = export.export_tables(spark, {"fire_summary": m["fire_summary"]}, f"{scratch}/h", incremental="append_hwm")
    assert log.first().rows > 0 and log2.first().rows == 0


@pytest.mark.parametrize("files", [1, 3])
def test_stream_equals_batch_for_any_file_split(spark, events, scratch, files):
    payloads = testdata.fire_payloads(events, resend=True)
    land_messages(payloads, f"{scratch}/in", files=files)
    q = pipelines.start_ingest(
        pipelines.fire_events(stream_messages(spark, f"{scratch}/in", max_files_per_trigger=1)),
        f"{scratch}/out",
        "acq_date",
        f"{scratch}/ck",
        name="prop",
        trigger="available_now",
    )
    q.awaitTermination()
    assert q.exception() is None
    cols = [c for c in read_table(spark, f"{scratch}/out").columns]
    streamed = read_table(spark, f"{scratch}/out").select(*cols)
    batch = dedup(parse.parse_fires(payloads), ["event_id"], keep="first").select(*cols)
    # Files hold whole months of messages in any order: most rows are late, none is lost.
    assert _same(streamed, batch)
