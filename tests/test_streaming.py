"""File-stream ingest: dedup across micro-batches, late data, replay, restart.

Each ``_arrive`` lands one file and drains it with an ``availableNow``
run from the same checkpoint, so every arrival is exactly one batch.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tephra.sinks.parquet import BATCH_KEY, IdempotentBatchWriter, read_table
from tephra.sources.landed import land_messages, stream_messages
from tephra.streaming import pipelines

HEADER = (
    "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,"
    "instrument,confidence,version,bright_ti5,frp,daynight"
)


def doc(*items):
    """items: (lat, hhmm) -> a fire CSV message of 2024-01-01."""
    lines = [f"{lat},1.0,330.0,0.4,0.4,2024-01-01,{t},N,VIIRS,h,2.0NRT,290.0,2.0,D" for lat, t in items]
    return "\r\n".join([HEADER] + lines)


def _arrive(spark, root, messages, dedup="sink"):
    land_messages(spark.createDataFrame([(m,) for m in messages], "value string"), f"{root}/landing")
    rows = pipelines.fire_events(stream_messages(spark, f"{root}/landing"), dedup=dedup)
    q = pipelines.start_ingest(
        rows,
        f"{root}/fires",
        "acq_date",
        f"{root}/_ckpt",
        name="fires_test",
        trigger="available_now",
        dedup=dedup,
    )
    q.awaitTermination()
    assert q.exception() is None
    return q.recentProgress


def _ids(spark, root):
    return sorted(r.event_id for r in read_table(spark, f"{root}/fires").collect())


A, B, C, D = (0.1, "1000"), (0.2, "1200"), (0.3, "0800"), (0.4, "1230")


def _named(*items):
    return sorted(f"N_2024-01-01_{t}_{lat}_1.0" for lat, t in items)


def _batches(spark, root):
    rows = spark.read.parquet(f"{root}/fires/_batches").orderBy("batch_id").collect()
    return [(r.rows, r.stored, r.late) for r in rows]


def test_state_dedup_across_batches_drops_late_rows(spark, scratch):
    _arrive(spark, scratch, [doc(A, A)], dedup="state")
    assert len(_ids(spark, scratch)) == 1  # duplicate inside one batch
    _arrive(spark, scratch, [doc(A, B)], dedup="state")  # A again in a later batch
    m3 = _arrive(spark, scratch, [doc(C, D)], dedup="state")  # C is older than the watermark
    assert _ids(spark, scratch) == _named(A, B, D)
    assert sum(s.numRowsDroppedByWatermark for p in m3 for s in p.stateOperators) >= 1


def test_late_first_arrivals_are_stored_and_counted(spark, scratch):
    _arrive(spark, scratch, [doc(A, A)])
    _arrive(spark, scratch, [doc(A, B)])  # A again in a later batch
    _arrive(spark, scratch, [doc(C, D)])  # C is older than the watermark, and new
    _arrive(spark, scratch, [doc(A, C, C)])  # late copies only
    assert _ids(spark, scratch) == _named(A, B, C, D)
    assert _batches(spark, scratch) == [(2, 1, 0), (2, 1, 0), (2, 2, 1), (3, 0, 3)]


def test_a_row_of_the_far_future_stops_nothing(spark, scratch):
    far = doc(A).replace("2024-01-01", "2099-01-01")
    _arrive(spark, scratch, [far, doc(A)])
    _arrive(spark, scratch, [doc(B, C)])
    assert _ids(spark, scratch) == _named(A, B, C)
    rejected = pipelines.fire_rejects_stream(spark.createDataFrame([(far,)], "value string")).collect()
    assert [r.reason for r in rejected] == ["future_time"]


def test_report_has_every_batch_of_a_long_run(spark, scratch):
    """More batches than the query itself remembers."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(6):
            land_messages(spark.createDataFrame([(doc((i / 10, "1000")),)], "value string"), f"{scratch}/landing", files=1)
        messages = stream_messages(spark, f"{scratch}/landing", max_files_per_trigger=1)
        q = pipelines.start_ingest(
            pipelines.fire_events(messages), f"{scratch}/fires", "acq_date", f"{scratch}/_ckpt",
            name="long_run", trigger="available_now", report_path=f"{scratch}/_report",
        )
        q.awaitTermination()
        assert q.exception() is None
        assert pipelines.batch_reports(spark).wait("long_run")
        report = spark.read.parquet(f"{scratch}/_report")
        assert [r.batch_id for r in report.orderBy("batch_id").collect()] == list(range(6))
        assert len(q.recentProgress) <= 2
        assert [x[1] for x in _batches(spark, scratch)] == [1] * 6
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_per_batch_mode_reproduces_the_original_job(spark, scratch):
    _arrive(spark, scratch, [doc(A, A)], dedup="per_batch")
    _arrive(spark, scratch, [doc(A, B)], dedup="per_batch")
    _arrive(spark, scratch, [doc(C, D)], dedup="per_batch")
    ids = _ids(spark, scratch)
    # Only copies inside one batch are removed; the late row C is kept.
    assert len(ids) == 5
    assert ids.count("N_2024-01-01_1000_0.1_1.0") == 2


def test_replayed_batch_is_not_duplicated(spark, scratch):
    ckpt = f"{scratch}/_ckpt"
    # The writer reads the query id from the checkpoint metadata file.
    spark.createDataFrame([('{"id":"q-1"}',)], "value string").coalesce(1).write.text(ckpt)
    import os
    import glob

    part = glob.glob(ckpt.replace("file:", "") + "/part-*")[0]
    os.rename(part, ckpt.replace("file:", "") + "/metadata")
    batch = spark.createDataFrame(
        [("e1", "2024-01-01"), ("e2", "2024-01-02")], "event_id string, acq_date string"
    ).withColumn("acq_date", F.to_date("acq_date"))
    w = IdempotentBatchWriter(f"{scratch}/sink", "acq_date", ckpt)
    w(batch, 0)
    w(batch, 0)  # replay after a failure
    w(batch.limit(1), 1)
    out = spark.read.parquet(f"{scratch}/sink")
    assert out.count() == 3
    assert sorted(r[0] for r in out.select(BATCH_KEY).distinct().collect()) == [
        "q-1-0000000000",
        "q-1-0000000001",
    ]


def test_batch_equals_stream_result(spark, scratch):
    """Parsing the same messages as a batch or through the stream gives the same rows."""
    from tephra.operators import dedup, parse

    messages = [doc(A, B), doc(B, D), doc(C)]
    _arrive(spark, scratch, messages)
    streamed = read_table(spark, f"{scratch}/fires").drop("processed_at")
    batch = dedup.dedup(
        parse.parse_fires(spark.createDataFrame([(m,) for m in messages], "value string")),
        ["event_id"],
        keep="first",
    )
    cols = sorted(batch.columns)
    assert sorted(streamed.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_two_streams_side_by_side_and_salted_writer(spark, scratch):
    from tephra.sources import testdata

    ev = testdata.load(spark, "/root/testdata/sf0.001", "events")
    land_messages(testdata.fire_payloads(ev), f"{scratch}/in_f")
    land_messages(testdata.quake_payloads(ev), f"{scratch}/in_q")
    qs = pipelines.start_both(
        stream_messages(spark, f"{scratch}/in_f"),
        stream_messages(spark, f"{scratch}/in_q"),
        scratch,
        trigger="available_now",
    )
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    assert read_table(spark, f"{scratch}/fires").count() == testdata.fx_fires(ev).count()
    assert read_table(spark, f"{scratch}/earthquakes").count() == testdata.usable(testdata.fx_quakes(ev)).count()

    ck = f"{scratch}/_checkpoints/fires"
    w = IdempotentBatchWriter(f"{scratch}/salted", "acq_date", ck, files_per_date=3)
    w(testdata.fires_table(ev), 0)
    out = spark.read.parquet(f"{scratch}/salted")
    assert out.count() == testdata.fx_fires(ev).count()
    days = out.select("acq_date").distinct().count()
    assert len(out.inputFiles()) <= 3 * days


def test_hot_record_is_spread_then_deduplicated(spark, scratch):
    hot = doc(*([A] * 3000 + [B]))
    land_messages(spark.createDataFrame([(hot,)], "value string"), f"{scratch}/landing")
    rows = pipelines.fire_events(stream_messages(spark, f"{scratch}/landing"), dedup="state", skew_salts=8)
    q = pipelines.start_ingest(
        rows, f"{scratch}/fires", "acq_date", f"{scratch}/_ckpt", name="hot", trigger="available_now", dedup="state"
    )
    q.awaitTermination()
    assert q.exception() is None
    assert len(_ids(spark, scratch)) == 2
    first = q.recentProgress[0].stateOperators
    # The salted first pass holds the hot id under several salts, the final pass once.
    assert sorted(s.numRowsTotal for s in first) == [2, 9]


def test_rejects_stream_writes_dead_letters(spark, scratch):
    msgs = [doc(A) + "\r\nbadrow,1,2,3,4,notadate,xx", doc(B) + "\r\n0.5,1.0,300.0,0.4,0.4,2024-13-01,7,N,VIIRS,h,2.0NRT,290.0,1.5,D"]
    land_messages(spark.createDataFrame([(m,) for m in msgs], "value string"), f"{scratch}/in")
    q = pipelines.start_rejects(
        pipelines.fire_rejects_stream(stream_messages(spark, f"{scratch}/in")),
        f"{scratch}/rejects",
        f"{scratch}/ck_rej",
        name="rej",
        trigger="available_now",
    )
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect())
    assert got == ["bad_acq_date", "malformed_csv"]


def test_writer_preview_reads_the_persisted_batch(spark, scratch, caplog):
    import logging

    ckpt = f"{scratch}/_ckpt"
    spark.createDataFrame([('{"id":"p"}',)], "value string").coalesce(1).write.text(ckpt)
    import glob
    import os

    os.rename(glob.glob(ckpt.replace("file:", "") + "/part-*")[0], ckpt.replace("file:", "") + "/metadata")
    batch = spark.createDataFrame([("e1", "2024-01-01")], "event_id string, acq_date string").withColumn(
        "acq_date", F.to_date("acq_date")
    )
    with caplog.at_level(logging.INFO, logger="tephra.sink"):
        IdempotentBatchWriter(f"{scratch}/sink", "acq_date", ckpt, preview_rows=5)(batch, 0)
    assert "batch 0 sample" in caplog.text
    assert spark.read.parquet(f"{scratch}/sink").count() == 1


def test_run_forever_returns_when_a_query_ends(spark, scratch):
    from tephra.sources import testdata

    ev = testdata.load(spark, "/root/testdata/sf0.001", "events")
    land_messages(testdata.fire_payloads(ev), f"{scratch}/in_f")
    land_messages(testdata.quake_payloads(ev), f"{scratch}/in_q")
    qs = pipelines.start_both(
        stream_messages(spark, f"{scratch}/in_f"),
        stream_messages(spark, f"{scratch}/in_q"),
        scratch,
        trigger="available_now",
    )
    pipelines.run_forever(qs, poll_seconds=1)  # returns once an availableNow query has drained
    for q in qs:
        q.awaitTermination()
    assert read_table(spark, f"{scratch}/fires").count() == testdata.fx_fires(ev).count()


def test_rolled_reports_keep_every_batch(spark, scratch, monkeypatch):
    path = f"{scratch}/_report"
    rows = [("fires", "run", i, i, 1, 0, 0, 5, f"2024-01-{1 + i // 40:02d}T00:00:00.000Z") for i in range(1000)]
    frame = spark.createDataFrame(rows, pipelines.PROGRESS_SCHEMA)
    frame.repartition(200).write.mode("append").parquet(path)

    def files():
        folder, fs = pipelines.hadoop_path(spark, path)
        return sum(st.getPath().getName().endswith(".parquet") for st in fs.listStatus(folder))

    # A stop after the merged file is in place leaves rows twice; the reader shows them once.
    with monkeypatch.context() as m:
        calls = iter(range(10))
        real = pipelines.must
        m.setattr(pipelines, "must", lambda done, what: real(done and next(calls) < 1, what))
        with pytest.raises(OSError, match="could not delete"):
            pipelines.roll_reports(spark, path)
    assert files() > 1 and pipelines.read_reports(spark, path).count() == 1000
    assert pipelines.roll_reports(spark, path) > 1
    assert files() == 1 and pipelines.read_reports(spark, path).count() == 1000
    assert pipelines.roll_reports(spark, path) == 0
    extra = ("fires", "run", 1000, 1, 1, 0, 0, 5, "2999-01-01T00:00:00.000Z")
    spark.createDataFrame([extra], pipelines.PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    assert pipelines.roll_reports(spark, path, keep_days=30) == 2
    left = pipelines.read_reports(spark, path).collect()
    assert files() == 1 and [r.batch_id for r in left] == [1000]
    assert pipelines.roll_reports(spark, f"{scratch}/none") == 0
