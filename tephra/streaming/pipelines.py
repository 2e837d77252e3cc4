"""Structured Streaming ingest of the two feeds.

``fire_events`` / ``quake_events`` turn a stream of raw messages into
event rows: the batch parsers plus an event-time watermark. De-duplication:

* ``"sink"`` (default) - copies are removed inside a micro-batch and against
  the stored rows of the batch's dates, by the sink. No row is lost: a first
  arrival later than any watermark is stored and counted as late.
* ``"state"`` - ``dropDuplicatesWithinWatermark``: no read of the stored table,
  state bounded by the watermark delay, but Spark drops every row older than
  the watermark, first arrivals too. For feeds known to be on time.
* ``"per_batch"`` - the original job: the watermark is declared but, with no
  stateful operator after it, only copies inside one micro-batch are removed.

Rows later than ``max_future`` from now are rejected before the watermark
(one row dated 2099 would otherwise move it past all others); with the other
unusable records they go to the dead letters.

``start_ingest`` runs a stream into an idempotent Parquet sink with a
checkpoint; ``trigger="available_now"`` drains what is there and stops
(backfills, tests), a duration string such as ``"15 minutes"`` runs a
processing-time trigger.
"""

from __future__ import annotations

import logging
import queue
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tephra import schemas
from tephra.operators import parse
from tephra.sinks.parquet import IdempotentBatchWriter, hadoop_path, must

log = logging.getLogger("tephra.stream")

FIRE_WATERMARK = "1 hour"
QUAKE_WATERMARK = "10 minutes"
# Processing-time trigger of the original job.
DEFAULT_TRIGGER = "15 minutes"
# An event further ahead of the clock than this is a bad record.
MAX_FUTURE = "1 day"
DEDUP_MODES = ("sink", "state", "per_batch")


def latest_accepted(max_future: str = MAX_FUTURE) -> Column:
    return F.current_timestamp() + F.expr(f"INTERVAL {max_future}")


def _dedup(rows: DataFrame, watermark: str, dedup: str, skew_salts: int | None) -> DataFrame:
    """Watermark, then (``state``) drop repeats of ``event_id`` across batches.

    A streaming dedup has no map-side combine: every copy of an id is
    shuffled to the task that owns the id. For a feed in which one record is
    repeated so often that its copies are a large share of a batch,
    ``skew_salts`` adds a first pass on ``(event_id, salt)`` with ``salt`` a
    per-row random number in ``[0, skew_salts)`` (seeded per partition, so a
    retried task draws the same salts). It doubles the state, so it is off
    unless asked for.
    """
    if dedup not in DEDUP_MODES:
        raise ValueError(f"dedup must be one of {DEDUP_MODES}")
    timed = rows.withWatermark("event_timestamp", watermark)
    if dedup != "state":
        return timed
    if skew_salts:
        timed = (
            timed.withColumn("_salt", F.floor(F.rand(17) * F.lit(skew_salts)))
            .dropDuplicatesWithinWatermark(["event_id", "_salt"])
            .drop("_salt")
        )
    return timed.dropDuplicatesWithinWatermark(["event_id"])


def fire_events(
    messages: DataFrame,
    watermark: str = FIRE_WATERMARK,
    dedup: str = "sink",
    cell_degrees: float = 0.22,
    rounding: str = "trunc",
    skew_salts: int | None = None,
    max_future: str = MAX_FUTURE,
) -> DataFrame:
    rows = parse.parse_fires(messages, cell_degrees, rounding)
    if dedup != "per_batch":
        # Without an event time there is no date to store a row under: rejects.
        rows = rows.where(F.col("event_timestamp").isNotNull())
        rows = rows.where(F.col("event_timestamp") <= latest_accepted(max_future))
    return _dedup(rows, watermark, dedup, skew_salts)


def quake_events(
    messages: DataFrame,
    watermark: str = QUAKE_WATERMARK,
    dedup: str = "sink",
    skew_salts: int | None = None,
    max_future: str = MAX_FUTURE,
) -> DataFrame:
    rows = parse.parse_quakes(messages)
    if dedup != "per_batch":
        rows = rows.where(F.col("event_timestamp") <= latest_accepted(max_future))
    return _dedup(rows, watermark, dedup, skew_salts)


def routed_fire_events(
    messages: DataFrame,
    watermark: str = FIRE_WATERMARK,
    cell_degrees: float = 0.22,
    rounding: str = "trunc",
    max_future: str = MAX_FUTURE,
) -> DataFrame:
    """Rows and dead letters of one parse, for an ingest with ``rejects_path``."""
    rows = parse.routed_fires(messages, latest_accepted(max_future), cell_degrees, rounding)
    return rows.withWatermark("event_timestamp", watermark)


def routed_quake_events(messages: DataFrame, watermark: str = QUAKE_WATERMARK, max_future: str = MAX_FUTURE) -> DataFrame:
    return parse.routed_quakes(messages, latest_accepted(max_future)).withWatermark("event_timestamp", watermark)


def start_ingest(
    rows: DataFrame,
    sink_path: str,
    partition_col: str,
    checkpoint: str,
    name: str,
    trigger: str = DEFAULT_TRIGGER,
    dedup: str = "sink",
    codec: str = "snappy",
    files_per_date: int | None = None,
    preview_rows: int = 0,
    watermark: str | None = None,
    report_path: str | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """``rows`` into the table at ``sink_path``. ``dedup`` names the mode ``rows`` was built
    for; ``watermark`` is what counts as late; ``report_path`` gets one row per micro-batch.
    With ``rejects_path`` the ``rows`` are routed (``routed_fire_events``) and their dead
    letters go there, batch by batch with the rows."""
    if rejects_path and dedup == "state":
        raise ValueError("a dedup by state would drop dead letters; give them a query of their own")
    if dedup not in DEDUP_MODES:
        raise ValueError(f"dedup must be one of {DEDUP_MODES}")
    if report_path:
        batch_reports(rows.sparkSession).add(name, report_path)
    columns = schemas.FIRES_COLUMNS if partition_col == "acq_date" else schemas.QUAKES_COLUMNS
    observed = rows.observe(
        name,
        (F.count_if(parse.KEPT) if rejects_path else F.count(F.lit(1))).alias("rows"),
        F.max("event_timestamp").alias("max_event_time"),
    )
    writer = IdempotentBatchWriter(
        sink_path,
        partition_col,
        checkpoint,
        dedup_keys=None if dedup == "state" else ["event_id"],
        against_stored=dedup == "sink",
        lateness=watermark or (FIRE_WATERMARK if partition_col == "acq_date" else QUAKE_WATERMARK),
        codec=codec,
        columns=columns,
        files_per_date=files_per_date,
        preview_rows=preview_rows,
        rejects_path=rejects_path,
    )
    w = (
        observed.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


PROGRESS_SCHEMA = (
    "stream string, run string, batch_id bigint, input_rows bigint, output_rows bigint, state_rows bigint, "
    "dropped_by_watermark bigint, wall_ms bigint, started_at string"
)


def progress_row(p, stream: str) -> tuple:
    """One report row of a micro-batch's progress."""
    observed = (p.observedMetrics or {}).get(p.name)
    state = p.stateOperators or []
    return (
        stream,
        str(p.runId),
        int(p.batchId),
        int(p.numInputRows),
        int(observed["rows"]) if observed is not None else 0,
        int(sum(s.numRowsTotal for s in state)),
        int(sum(s.numRowsDroppedByWatermark for s in state)),
        int((p.durationMs or {}).get("triggerExecution", 0)),
        p.timestamp,
    )


class BatchReports(StreamingQueryListener):
    """Stores one row per micro-batch of the registered queries, as each batch ends.

    Progress that a query itself remembers is limited to its newest updates; the
    stored report has every batch of a run, however long. Events are handed to one
    writer thread: the listener's own thread must not run jobs.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}
        self.names_by_run: dict[str, str] = {}
        self.ended: dict[str, threading.Event] = {}
        self.todo: queue.Queue = queue.Queue()
        threading.Thread(target=self._store, daemon=True, name="batch-reports").start()

    def add(self, name: str, path: str) -> None:
        self.paths[name] = path
        self.ended[name] = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name in self.paths:
            self.names_by_run[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        if event.progress.name in self.paths:
            self.todo.put((event.progress.name, progress_row(event.progress, event.progress.name)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Follows every progress event of its run.
        name = self.names_by_run.pop(str(event.runId), None)
        if name:
            self.todo.put((name, None))

    def _store(self) -> None:
        while True:
            name, row = self.todo.get()
            if row is None:
                self.ended[name].set()
                continue
            try:
                frame = self.spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1)
                frame.write.mode("append").parquet(self.paths[name])
            except Exception:  # noqa: BLE001 - a report must not end the ingest
                log.exception("batch report of %s, batch %s", name, row[2])

    def wait(self, name: str, seconds: float = 120) -> bool:
        """Wait until the last batch of an ended query is stored."""
        return self.ended[name].wait(seconds)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The stored batch report, one row per micro-batch of a run.

    A merge that stopped half-way leaves rows twice, never none.
    """
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path).dropDuplicates(["stream", "run", "batch_id"])


def roll_reports(spark: SparkSession, path: str, keep_days: int | None = None) -> int:
    """Merge the one-row files of a report into one and drop batches started more than ``keep_days`` ago.

    Only the files listed at the start are read, merged and deleted; the merged one is moved
    in before they go, so a stop in between loses nothing, and a running ingest may go on
    appending. Returns the number of files merged.
    """
    folder, fs = hadoop_path(spark, path)
    if not fs.exists(folder):
        return 0
    old = [st.getPath() for st in fs.listStatus(folder) if st.isFile() and st.getPath().getName().endswith(".parquet")]
    if not old or (len(old) == 1 and keep_days is None):
        return 0
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(*(p.toString() for p in old))
    rows = rows.dropDuplicates(["stream", "run", "batch_id"])
    if keep_days is not None:
        began = F.try_to_timestamp("started_at")
        rows = rows.where(began.isNull() | (began >= F.current_timestamp() - F.make_interval(days=F.lit(keep_days))))
    work = f"{path.rstrip('/')}/_rolling"
    rows.coalesce(1).write.mode("overwrite").parquet(work)
    aside, _ = hadoop_path(spark, work)
    for st in fs.listStatus(aside):
        name = st.getPath().getName()
        if name.endswith(".parquet"):
            target, _ = hadoop_path(spark, f"{path.rstrip('/')}/{name}")
            must(fs.rename(st.getPath(), target), f"move {name}")
    for p in old:
        must(fs.delete(p, False) or not fs.exists(p), f"delete {p.toString()}")
    must(fs.delete(aside, True) or not fs.exists(aside), f"delete {work}")
    return len(old)


_REPORTS: dict[int, BatchReports] = {}


def batch_reports(spark: SparkSession) -> BatchReports:
    """The session's report listener (one per session)."""
    key = id(spark.sparkContext)
    if key not in _REPORTS:
        _REPORTS[key] = BatchReports(spark)
        spark.streams.addListener(_REPORTS[key])
    return _REPORTS[key]


def start_both(
    fire_messages: DataFrame,
    quake_messages: DataFrame,
    base_path: str,
    trigger: str = DEFAULT_TRIGGER,
    dedup: str = "sink",
    rejects: bool = True,
    fires_watermark: str = FIRE_WATERMARK,
    quakes_watermark: str = QUAKE_WATERMARK,
    codec: str = "snappy",
    files_per_date: int | None = None,
    skew_salts: int | None = None,
    max_future: str = MAX_FUTURE,
) -> list[StreamingQuery]:
    """Start the fire and quake ingest queries side by side.

    Tables go to ``<base>/fires`` and ``<base>/earthquakes``, checkpoints to
    ``<base>/_checkpoints/<name>`` (one per query, on the shared file system).
    With ``dedup="state"`` the watermark delays bound how long ids are remembered;
    in every mode they say which rows count as late. Each batch is reported in
    ``<base>/_reports/<feed>``. ``rejects`` keeps dead letters (``<base>/_rejects/<feed>``):
    from the same parse and batch as the rows; in the other modes of ``dedup`` a query
    per feed reads the source a second time.
    """
    extra = []
    one_parse = rejects and dedup == "sink"
    if one_parse:
        fires = routed_fire_events(fire_messages, fires_watermark, max_future=max_future)
        quakes = routed_quake_events(quake_messages, quakes_watermark, max_future=max_future)
    else:
        fires = fire_events(
            fire_messages, watermark=fires_watermark, dedup=dedup, skew_salts=skew_salts, max_future=max_future
        )
        quakes = quake_events(
            quake_messages, watermark=quakes_watermark, dedup=dedup, skew_salts=skew_salts, max_future=max_future
        )
    if rejects and not one_parse:
        extra = [
            start_rejects(
                fire_rejects_stream(fire_messages, max_future),
                f"{base_path}/_rejects/fires",
                f"{base_path}/_checkpoints/fires_rejects",
                name="fires_rejects",
                trigger=trigger,
            ),
            start_rejects(
                parse.quake_rejects(quake_messages, latest_accepted(max_future)),
                f"{base_path}/_rejects/earthquakes",
                f"{base_path}/_checkpoints/earthquakes_rejects",
                name="earthquakes_rejects",
                trigger=trigger,
            ),
        ]
    return extra + [
        start_ingest(
            fires,
            f"{base_path}/fires",
            "acq_date",
            f"{base_path}/_checkpoints/fires",
            name="fires_ingest",
            trigger=trigger,
            dedup=dedup,
            codec=codec,
            files_per_date=files_per_date,
            watermark=fires_watermark,
            report_path=f"{base_path}/_reports/fires",
            rejects_path=f"{base_path}/_rejects/fires" if one_parse else None,
        ),
        start_ingest(
            quakes,
            f"{base_path}/earthquakes",
            "event_date",
            f"{base_path}/_checkpoints/earthquakes",
            name="earthquakes_ingest",
            trigger=trigger,
            dedup=dedup,
            codec=codec,
            files_per_date=files_per_date,
            watermark=quakes_watermark,
            report_path=f"{base_path}/_reports/earthquakes",
            rejects_path=f"{base_path}/_rejects/earthquakes" if one_parse else None,
        ),
    ]


def run_forever(queries: list[StreamingQuery], poll_seconds: int = 10) -> None:
    """Block until any of the queries stops, then re-raise its failure.

    Polls the given queries themselves (not the session-wide termination
    flag, which other queries of the session may already have set).
    """
    while all(q.isActive for q in queries):
        queries[0].awaitTermination(poll_seconds)
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"{q.name} failed: {q.exception()}")


def fire_rejects_stream(messages: DataFrame, max_future: str = MAX_FUTURE) -> DataFrame:
    """Stream of rejected fire lines (``source, record, reason``)."""
    full = parse.parse_fire_lines(parse.fire_lines(messages), keep_corrupt=True)
    return parse.fire_rejects(full, latest_accepted(max_future))


def start_rejects(
    rejects: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    trigger: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Dead letters to an append-only Parquet table (the file sink's own log
    makes the output exactly-once across restarts)."""
    w = (
        rejects.withColumn("rejected_at", F.current_timestamp())
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .queryName(name)
    )
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=trigger)
    return w.start()
