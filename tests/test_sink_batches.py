"""The micro-batch sink: recent keys, late rows, the batch log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tephra import schemas
from tephra.operators import parse
from tephra.sinks import parquet
from tephra.sinks.parquet import BATCH_KEY, BATCH_LOG, RECENT, IdempotentBatchWriter, read_batch_log, roll_batch_log

from tephra.sources import testdata

SCHEMA = "event_id string, time string"


@pytest.fixture()
def writer(spark, scratch, monkeypatch):
    monkeypatch.setattr(parquet, "checkpoint_query_id", lambda spark, checkpoint: "q")
    return IdempotentBatchWriter(
        f"{scratch}/t", "day", f"{scratch}/ck", dedup_keys=["event_id"], against_stored=True, lateness="1 hour"
    )


def batch(spark, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA).withColumn("event_timestamp", F.col("time").cast("timestamp"))
    return df.withColumn("day", F.to_date("event_timestamp"))


def stored(spark, writer):
    return sorted(r[0] for r in spark.read.parquet(writer.path).select("event_id").collect())


def logged(spark, writer):
    rows = read_batch_log(spark, writer.path).orderBy("batch_id").collect()
    return [(r["rows"], r["stored"], r["late"]) for r in rows]


def test_on_time_batches_read_no_stored_event(spark, writer, monkeypatch):
    writer(batch(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:10:00")), 0)

    def refuse(*args):
        raise AssertionError("stored events were read")

    monkeypatch.setattr(writer, "_not_stored", refuse)
    writer(batch(spark, ("a", "2024-01-01 10:00:00"), ("c", "2024-01-01 10:20:00"), ("c", "2024-01-01 10:20:00")), 1)
    writer(batch(spark, ("b", "2024-01-01 10:10:00"), ("d", "2024-01-01 23:59:00")), 2)
    writer(batch(spark, ("d", "2024-01-01 23:59:00"), ("e", "2024-01-02 00:10:00")), 3)
    assert stored(spark, writer) == ["a", "b", "c", "d", "e"]
    assert logged(spark, writer) == [(2, 2, 0), (3, 1, 0), (2, 1, 0), (2, 1, 0)]
    with pytest.raises(AssertionError):
        writer(batch(spark, ("late", "2024-01-01 11:00:00")), 4)


def test_late_rows_meet_the_stored_keys_of_their_dates(spark, writer):
    writer(batch(spark, ("a", "2024-01-01 10:00:00")), 0)
    writer(batch(spark, ("b", "2024-01-03 10:00:00")), 1)
    writer(batch(spark, ("a", "2024-01-01 10:00:00"), ("x", "2024-01-01 09:00:00"), ("c", "2024-01-03 10:30:00")), 2)
    writer(batch(spark, ("x", "2024-01-01 09:00:00"), ("b", "2024-01-03 10:00:00"), ("y", None)), 3)
    writer(batch(spark, ("y", None)), 4)
    assert stored(spark, writer) == ["a", "b", "c", "x", "y"]
    assert logged(spark, writer)[:4] == [(1, 1, 0), (1, 1, 0), (3, 2, 2), (3, 1, 1)]


def test_recent_keys_are_bounded_by_event_time(spark, writer):
    for i in range(12):
        writer(batch(spark, (f"e{i}", f"2024-01-01 {i:02}:00:00")), i)
    snapshots = spark.read.parquet(f"{writer.path}/{RECENT}").groupBy(BATCH_KEY).count().collect()
    assert sorted((r[0], r[1]) for r in snapshots) == [("q-0000000010", 3), ("q-0000000011", 3)]


def test_a_replay_changes_nothing(spark, writer):
    first, second = batch(spark, ("a", "2024-01-01 10:00:00")), batch(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:01:00"))
    writer(first, 0)
    for _ in range(3):
        writer(second, 1)
    writer(batch(spark, ("b", "2024-01-01 10:01:00")), 2)
    assert stored(spark, writer) == ["a", "b"]
    assert logged(spark, writer) == [(1, 1, 0), (2, 1, 0), (1, 0, 0)]


def test_a_new_checkpoint_meets_all_stored_keys(spark, writer, monkeypatch):
    writer(batch(spark, ("a", "2024-01-01 10:00:00")), 0)
    writer._query_id = "r"
    writer(batch(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 12:00:00")), 0)
    writer(batch(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 12:00:00")), 1)
    assert stored(spark, writer) == ["a", "b"]


def test_a_copy_that_arrives_while_a_compaction_swaps_folders(spark, writer):
    """Between the two moves a date has its rows only in the work folder."""
    writer(batch(spark, ("a", "2024-01-01 10:00:00")), 0)
    writer(batch(spark, ("b", "2024-01-03 10:00:00")), 1)
    old = f"{writer.path}/_compaction/2024-01-01/old"
    folder, fs = parquet.hadoop_path(spark, old)
    fs.mkdirs(folder)
    name = f"{BATCH_KEY}=q-0000000000"
    parquet._move(spark, f"{writer.path}/day=2024-01-01/{name}", f"{old}/{name}")
    writer(batch(spark, ("a", "2024-01-01 10:00:00")), 2)
    assert logged(spark, writer)[2] == (1, 0, 1)


def test_the_mark_comes_from_one_file_and_old_rows_are_merged(spark, writer, monkeypatch):
    for i in range(8):
        writer(batch(spark, (f"e{i}", f"2024-01-0{i + 1} 10:00:00")), i)
    before = sorted(map(tuple, read_batch_log(spark, writer.path).select("batch_id", "rows", "late", "high_water").collect()))
    assert roll_batch_log(spark, writer.path, keep=3) == 5
    assert roll_batch_log(spark, writer.path, keep=3) == 0
    folder, fs = parquet.hadoop_path(spark, f"{writer.path}/{BATCH_LOG}")
    names = [st.getPath().getName() for st in fs.listStatus(folder) if st.isDirectory()]
    assert len([n for n in names if n.startswith(BATCH_KEY)]) == 4  # three batches and one merged file
    after = sorted(map(tuple, read_batch_log(spark, writer.path).select("batch_id", "rows", "late", "high_water").collect()))
    assert after == before

    def refuse(*args):
        raise AssertionError("the whole log was read")

    monkeypatch.setattr(parquet, "read_batch_log", refuse)
    writer(batch(spark, ("old", "2024-01-07 10:00:00")), 8)
    writer(batch(spark, ("old", "2024-01-07 10:00:00")), 9)
    monkeypatch.undo()
    monkeypatch.setattr(parquet, "checkpoint_query_id", lambda spark, checkpoint: "q")
    assert roll_batch_log(spark, writer.path, keep=1) == 4
    assert logged(spark, writer)[-2:] == [(1, 1, 1), (1, 0, 1)]
    assert len(logged(spark, writer)) == 10


LINES = [
    "0.1,1.0,300.0,0.4,0.4,2024-01-01,1000,N,VIIRS,h,2.0NRT,290.0,1.5,D",
    "0.2,1.0,300.0,0.4,0.4,2024-01-01,1010,N,VIIRS,h,2.0NRT,290.0,1.5,D",
    "0.2,1.0,300.0,0.4,0.4,2024-13-01,1010,N,VIIRS,h,2.0NRT,290.0,1.5,D",
    "badrow,1,2,3,4,notadate,xx",
]


def test_rows_and_dead_letters_come_from_one_batch(spark, scratch, monkeypatch):
    """A stop between the two writes and a replay: every record is a stored row or a dead letter, once."""
    monkeypatch.setattr(parquet, "checkpoint_query_id", lambda spark, checkpoint: "q")
    writer = IdempotentBatchWriter(
        f"{scratch}/fires", "acq_date", f"{scratch}/ck", dedup_keys=["event_id"], against_stored=True,
        lateness="1 hour", columns=schemas.FIRES_COLUMNS, rejects_path=f"{scratch}/_rejects/fires",
    )
    messages = spark.createDataFrame([("\n".join(LINES),)], "value string")
    batch = parse.routed_fires(messages, F.current_timestamp())
    real = writer._write

    def stop(*args):
        raise RuntimeError("stopped between the two writes")

    monkeypatch.setattr(writer, "_write", stop)
    with pytest.raises(RuntimeError):
        writer(batch, 0)
    monkeypatch.setattr(writer, "_write", real)
    writer(batch, 0)
    writer(batch, 0)
    letters = spark.read.parquet(f"{scratch}/_rejects/fires")
    assert sorted(r["reason"] for r in letters.collect()) == ["bad_acq_date", "malformed_csv"]
    assert spark.read.parquet(f"{scratch}/fires").count() == 2
    row = read_batch_log(spark, f"{scratch}/fires").first()
    assert (row["records"], row["rejected"], row["rows"], row["stored"]) == (4, 2, 2, 2)
    good = parse.routed_fires(spark.createDataFrame([("\n".join(LINES[:2]),)], "value string"), F.current_timestamp())
    writer(good, 1)
    assert letters.count() == spark.read.parquet(f"{scratch}/_rejects/fires").count() == 2


def test_dead_letters_are_looked_for_by_all_tasks(spark, scratch, monkeypatch):
    """No writing task reads the whole batch, and files follow the letters' bytes, not only their number."""
    writer = IdempotentBatchWriter(f"{scratch}/fires", "acq_date", f"{scratch}/ck", rejects_path=f"{scratch}/_rejects/fires")
    ids = spark.range(0, 4000, 1, 8)
    reason = F.when(F.col("id") % 100 == 0, F.lit("bad"))
    whole = ids.select(F.concat(F.lit("record "), "id").alias(parse.RECORD), reason.alias(parse.REASON))
    spread, narrowed = [], []
    repartition, coalesce = type(whole).repartition, type(whole).coalesce
    monkeypatch.setattr(type(whole), "repartition", lambda df, n, *c: spread.append(n) or repartition(df, n, *c))
    monkeypatch.setattr(type(whole), "coalesce", lambda df, n: narrowed.append(n) or coalesce(df, n))
    assert writer._write_rejects(whole, "q-0") == (4000, 40)
    monkeypatch.setattr(parquet, "BYTES_PER_FILE", 100)
    assert writer._write_rejects(whole, "q-1") == (4000, 40)
    monkeypatch.undo()
    assert not narrowed and spread[0] == 1 and spread[1] == -(-sum(len(f"record {i}") for i in range(0, 4000, 100)) // 100)
    for key in ("q-0", "q-1"):
        letters = spark.read.parquet(f"{scratch}/_rejects/fires/{BATCH_KEY}={key}").collect()
        assert sorted(r["record"] for r in letters) == sorted(f"record {i}" for i in range(0, 4000, 100))
        assert {(r["source"], r["reason"]) for r in letters} == {("fires", "bad")}


@pytest.mark.parametrize("case", ["rows", "bad records", "no dead letters"])
def test_steps_of_a_batch_read_partitions_of_bounded_bytes(spark, scratch, writer, monkeypatch, case):
    """Two landed files give two large partitions; no later step reads one of them whole, bad records included."""
    bad = case == "bad records"
    text = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(0, 40000, 1, 2).select(
        F.when(~F.lit(bad), text).alias("event_id"),
        F.timestamp_seconds(F.lit(1704103200) + F.col("id") % 600).alias("event_timestamp"),
        F.lit("2024-01-01").cast("date").alias("day"),
        text.alias(parse.RECORD),
        F.when(F.lit(bad), F.lit("bad")).alias(parse.REASON),
        F.lit(not bad).alias(parse.KEPT),
    )
    if case == "no dead letters":
        rows, step = rows.drop(parse.RECORD, parse.REASON, parse.KEPT), "_counts"
    else:
        writer.rejects_path, step = f"{scratch}/_rejects/t", "_write_rejects"
    seen, real = [], getattr(writer, step)

    def watch(whole, *rest):
        sizes = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((sum(sizes), max(sizes), whole.storageLevel.useMemory))
        return real(whole, *rest)

    monkeypatch.setattr(writer, step, watch)
    small = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    settings, layout = {k: spark.conf.get(k) for k in small}, spark.conf.get(parquet.CACHED_LAYOUT, None)
    for k in small:
        spark.conf.set(k, "64k")
    try:
        writer(rows, 0)
        assert spark.conf.get(parquet.CACHED_LAYOUT, None) == layout
    finally:
        for k, v in settings.items():
            spark.conf.set(k, v)
    assert seen[0][0] == 40000 and seen[0][1] <= 40000 // 4
    assert seen[0][2]  # the steps read what is persisted, not the messages once more
    log = read_batch_log(spark, writer.path).first()
    want = {"rows": (40000, 0, 40000), "bad records": (40000, 40000, 0), "no dead letters": (None, None, 40000)}
    assert (log["records"], log["rejected"], log["stored"]) == want[case]


def test_routed_parse_equals_the_two_parses(spark):
    ev = testdata.load(spark, "/root/testdata/sf0.001", "events")
    latest = F.lit("2100-01-01").cast("timestamp")
    for payloads, routed, kept, rejects in (
        (testdata.fire_payloads(ev, junk=True), parse.routed_fires, parse.parse_fires, lambda p: parse.split_fires(p)[1]),
        (testdata.quake_payloads(ev, junk=True), parse.routed_quakes, parse.parse_quakes, parse.quake_rejects),
    ):
        both = routed(payloads, latest)
        rows = both.where(parse.KEPT).drop(parse.RECORD, parse.REASON, parse.KEPT, "processed_at")
        want = kept(payloads).drop("processed_at").where("event_timestamp is not null and event_timestamp <= '2100-01-01'")
        assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
        letters = both.where(F.col(parse.REASON).isNotNull()).groupBy(parse.REASON).count()
        counted = {r[0]: r[1] for r in rejects(payloads).groupBy("reason").count().collect()}
        assert {r[0]: r[1] for r in letters.collect() if r[0] != "future_time"} == counted
