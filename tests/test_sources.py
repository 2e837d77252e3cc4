"""Sources: Kafka option map, landed files, and the derived fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tephra import schemas
from tephra.operators import parse
from tephra.sinks.parquet import BATCH_KEY, IdempotentBatchWriter, compact_date, read_table
from tephra.sources import kafka, testdata
from tephra.sources.landed import land_messages, read_messages

SF = "/root/testdata/sf0.001"


def test_kafka_options():
    o = kafka.kafka_options("broker:9092", "fires-topic", group_id="g", max_offsets_per_trigger=1000)
    assert o == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "fires-topic",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "kafka.group.id" not in kafka.kafka_options("b:1", "t")
    assert kafka.kafka_options("b:1", "t", min_partitions=64)["minPartitions"] == "64"


def test_parsed_messages_equal_the_direct_tables(spark):
    ev = testdata.load(spark, SF, "events")
    cols = [c for c in schemas.FIRES_COLUMNS]
    parsed = parse.parse_fires(testdata.fire_payloads(ev)).select(*cols)
    direct = testdata.fires_table(ev).select(*cols)
    assert parsed.exceptAll(direct).count() == 0 and direct.exceptAll(parsed).count() == 0
    qcols = [c for c in schemas.QUAKES_COLUMNS if c != "processed_at"]
    qp = parse.parse_quakes(testdata.quake_payloads(ev)).select(*qcols)
    qd = testdata.quakes_table(ev).select(*qcols)
    assert qp.exceptAll(qd).count() == 0 and qd.exceptAll(qp).count() == 0


def test_messages_are_bounded_and_resent(spark):
    ev = testdata.load(spark, SF, "events")
    docs = testdata.fire_payloads(ev, rows_per_doc=50, resend=True)
    n_lines = docs.select((F.size(F.split("value", "\r\n")) - 1).alias("n"))
    assert n_lines.agg(F.max("n")).first()[0] <= 50
    assert docs.where("copy = 1").count() == docs.where("copy = 0").count()


def test_landed_roundtrip(spark, scratch):
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    land_messages(df, f"{scratch}/l", files=2)
    assert sorted(r.value for r in read_messages(spark, f"{scratch}/l").collect()) == ["a", "b"]


def test_compact_date(spark, scratch):
    ck = f"{scratch}/ck"
    spark.createDataFrame([('{"id":"q"}',)], "value string").coalesce(1).write.text(ck)
    import glob
    import os

    os.rename(glob.glob(ck.replace("file:", "") + "/part-*")[0], ck.replace("file:", "") + "/metadata")
    w = IdempotentBatchWriter(f"{scratch}/t", "acq_date", ck)
    base = spark.createDataFrame([("e1",), ("e2",)], "event_id string").withColumn(
        "acq_date", F.to_date(F.lit("2024-01-01"))
    )
    for b in range(3):
        w(base.withColumn("event_id", F.concat("event_id", F.lit(str(b)))), b)
    before = sorted(r.event_id for r in read_table(spark, f"{scratch}/t").collect())
    assert compact_date(spark, f"{scratch}/t", "acq_date", "2024-01-01") == 6
    after = read_table(spark, f"{scratch}/t", drop_batch_key=False)
    assert sorted(r.event_id for r in after.collect()) == before
    assert [r[0] for r in after.select(BATCH_KEY).distinct().collect()][0].startswith("compacted-")
    assert len(after.inputFiles()) == 1


def test_wholetext_files_are_one_message_each(spark, scratch):
    import os

    from tephra.sources.landed import stream_messages

    root = f"{scratch}/text".replace("file:", "")
    os.makedirs(root)
    header = (
        "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,"
        "instrument,confidence,version,bright_ti5,frp,daynight"
    )
    for i, t in enumerate(("0700", "0800")):
        with open(f"{root}/m{i}.csv", "w") as fh:
            fh.write(f"{header}\r\n0.5,1.0,330.0,0.4,0.4,2024-01-01,{t},N,VIIRS,h,2.0NRT,290.0,2.0,D\r\n")
    batch = read_messages(spark, root, fmt="text")
    assert batch.count() == 2
    assert parse.parse_fires(batch).count() == 2
    q = (
        parse.parse_fires(stream_messages(spark, root, fmt="text"))
        .writeStream.format("memory").queryName("wholetext_test")
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert spark.sql("SELECT COUNT(*) FROM wholetext_test").first()[0] == 2
