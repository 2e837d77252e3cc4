"""Registered queries that write and read back: sinks and stream runs.

Each run takes a fresh folder under the shared scratch root
(``spark.checkpoint.dir``), lands the raw messages derived from
``events`` there, runs the job and returns the written table as a
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tephra import schemas
from tephra.operators import parse
from tephra.session import prepare, run_dir
from tephra.sinks.parquet import read_batch_log, read_table, write_partitioned
from tephra.sources import testdata
from tephra.sources.landed import land_messages, stream_messages
from tephra.streaming import pipelines

# Columns that a fire's event id determines (copies of an id agree on them).
FIRE_ID_COLUMNS = [
    "latitude",
    "longitude",
    "acq_date",
    "acq_time",
    "satellite",
    "event_timestamp",
    "event_type",
    "event_id",
    "cluster_id",
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return testdata.load(spark, sf_dir, "events")


def q_sink_fires_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "sink-fires")
    fires = parse.parse_fires(testdata.fire_payloads(_events(spark, sf_dir)))
    write_partitioned(fires, f"{root}/fires", "acq_date", mode="append")
    return read_table(spark, f"{root}/fires").select(*schemas.FIRES_COLUMNS)


def q_sink_quakes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "sink-quakes")
    quakes = parse.parse_quakes(testdata.quake_payloads(_events(spark, sf_dir)))
    write_partitioned(quakes, f"{root}/earthquakes", "event_date", mode="append")
    cols = [c for c in schemas.QUAKES_COLUMNS if c != "processed_at"]
    return read_table(spark, f"{root}/earthquakes").select(*cols)


_FEEDS = {
    "fires": (testdata.fire_payloads, pipelines.fire_events, "acq_date"),
    "earthquakes": (testdata.quake_payloads, pipelines.quake_events, "event_date"),
}


def run_stream(
    spark: SparkSession,
    sf_dir: str,
    feed: str,
    arrivals: int = 1,
    dedup: str = "sink",
) -> tuple[str, DataFrame]:
    """Land the feed's messages and ingest them with ``availableNow`` runs.

    ``arrivals=1``: every message (each sent twice) lands before one run.
    ``arrivals=2``: the first copies of most messages land and are ingested;
    then come all second copies, which must change nothing, together with the
    first copies of the remaining messages, which must all be stored although
    most of their rows are older than the watermark. Every message also holds
    an event of the far future, which must move nothing and not be stored.
    Returns the sink path and the stored batch report.
    """
    make_payloads, make_rows, part = _FEEDS[feed]
    root = run_dir(spark, f"stream-{feed}")
    landing, sink, ckpt = f"{root}/landing", f"{root}/{feed}", f"{root}/_checkpoint"
    payloads = make_payloads(_events(spark, sf_dir), resend=True, future=True)
    if arrivals == 1:
        waves = [payloads]
    else:
        first, late = F.col("copy") == 0, testdata.first_arrives_late()
        waves = [payloads.where(first & ~late), payloads.where(F.col("copy") == 1).union(payloads.where(first & late))]
    # Unique per run, so concurrent runs in one session never collide.
    name = f"{feed}_ingest_{root.rsplit('-', 1)[-1]}"
    for wave in waves:
        # One file per core, as a topic with that many partitions would give.
        land_messages(wave, landing, files=spark.sparkContext.defaultParallelism)
        rows = make_rows(stream_messages(spark, landing), dedup=dedup)
        q = pipelines.start_ingest(
            rows, sink, part, ckpt, name=name, trigger="available_now", dedup=dedup, report_path=f"{root}/_report"
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"{feed} stream failed: {q.exception()}")
        if not pipelines.batch_reports(spark).wait(name):
            raise RuntimeError(f"{feed}: the batch report was not stored in time")
    return sink, pipelines.read_reports(spark, f"{root}/_report")


def _stream_query(feed: str, arrivals: int, dedup: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sink, _ = run_stream(spark, sf_dir, feed, arrivals, dedup)
        if feed == "fires":
            return read_table(spark, sink).select(*FIRE_ID_COLUMNS)
        return read_table(spark, sink).select(*(c for c in schemas.QUAKES_COLUMNS if c != "processed_at"))

    return run


def q_stream_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds side by side on a processing-time trigger: rows stored per table and date."""
    root = run_dir(spark, "stream-both")
    messages = {}
    for feed, (make_payloads, _, _) in _FEEDS.items():
        landing = f"{root}/{feed}-in"
        land_messages(make_payloads(_events(spark, sf_dir), resend=True), landing, files=spark.sparkContext.defaultParallelism)
        messages[feed] = stream_messages(spark, landing)
    running = pipelines.start_both(messages["fires"], messages["earthquakes"], f"{root}/events", trigger="1 second")
    try:
        for q in running:
            q.processAllAvailable()  # raises what ended the query
    finally:
        for q in running:
            q.stop()
    out = None
    for feed, (_, _, part) in _FEEDS.items():
        stored = read_table(spark, f"{root}/events/{feed}").groupBy(F.lit(feed).alias("table_name"), F.col(part).alias("event_date"))
        n = stored.agg(F.count(F.lit(1)).alias("n_rows"))
        out = n if out is None else out.unionByName(n)
    return out


def q_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read, rows stored and late rows, per run of a two-arrival fire stream.

    Run 1 reads second copies, of which nothing is stored, and late first
    copies, of which everything is.
    """
    sink, report = run_stream(spark, sf_dir, "fires", arrivals=2)
    runs = Window.partitionBy("stream").orderBy("first_batch")
    batches = read_batch_log(spark, sink).select("batch_id", "stored", "late")
    return (
        report.join(batches, "batch_id", "left")
        .groupBy(F.lit("fires").alias("stream"), F.col("run").alias("run_id"))
        .agg(
            F.min("batch_id").alias("first_batch"),
            F.sum("input_rows").alias("input_rows"),
            F.coalesce(F.sum("stored"), F.lit(0)).alias("output_rows"),
            F.coalesce(F.sum("late"), F.lit(0)).alias("late_rows"),
        )
        .withColumn("run", F.row_number().over(runs) - 1)
        .select("stream", "run", "input_rows", "output_rows", "late_rows")
    )


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters that the ingest stores next to its rows, when every message carries a bad record."""
    root = run_dir(spark, "stream-rejects")
    run = root.rsplit("-", 1)[-1]
    routed = {"fires": pipelines.routed_fire_events, "earthquakes": pipelines.routed_quake_events}
    for feed, (make_payloads, _, part) in _FEEDS.items():
        land_messages(make_payloads(_events(spark, sf_dir), junk=True), f"{root}/{feed}-in", files=spark.sparkContext.defaultParallelism)
        q = pipelines.start_ingest(
            routed[feed](stream_messages(spark, f"{root}/{feed}-in")), f"{root}/{feed}", part, f"{root}/{feed}-checkpoint",
            name=f"{feed}_routed_{run}", trigger="available_now", rejects_path=f"{root}/_rejects/{feed}",
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"{feed} stream failed: {q.exception()}")
    fires, quakes = (spark.read.parquet(f"{root}/_rejects/{feed}") for feed in _FEEDS)
    letters = fires.unionByName(quakes)
    return letters.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_records"))


def stream_queries() -> dict:
    return {
        "sink_fires_roundtrip": q_sink_fires_roundtrip,
        "sink_quakes_roundtrip": q_sink_quakes_roundtrip,
        "stream_fires_e2e": _stream_query("fires", 1, "state"),
        "stream_quakes_e2e": _stream_query("earthquakes", 1, "state"),
        "stream_dedup_fires": _stream_query("fires", 2, "sink"),
        "stream_dedup_quakes": _stream_query("earthquakes", 2, "sink"),
        "stream_both": q_stream_both,
        "batch_metrics": q_batch_metrics,
        "stream_rejects": q_stream_rejects,
    }
