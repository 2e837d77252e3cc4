"""Parquet sinks: date-partitioned append, clustered snapshot, idempotent micro-batches.

Write layout at scale: before a partitioned write the rows go through a
``REBALANCE`` on the partition column. Adaptive execution then splits a
hot date over several tasks (several files) and merges small dates into
one task, so neither a day holding a third of all rows nor hundreds of
tiny days produce bad files. A clustered snapshot is split by ranges of the
date and the clustering columns instead: bounds from a sample, and a row hash as last
key, so a hot value is shared by several tasks. The files of a date then hold
ranges that meet in one value at most, and readers skip whole files and, as rows are
sorted within a file, row groups.
"""

from __future__ import annotations

import json
import logging
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tephra.operators.parse import KEPT, REASON, RECORD

BATCH_KEY = "batch_key"
log = logging.getLogger("tephra.sink")


def observed(obs: Observation, **defaults):
    """Metrics of an ``Observation`` after its action, or ``defaults`` when there are none.

    An input without partitions runs no task and leaves no metrics row. A caller that
    deletes by these numbers must tell "nothing written" from "unknown" by itself.
    """
    try:
        got = obs.get
    except Py4JError:  # no row to read
        return defaults
    return {k: (got[k] if k in got else v) for k, v in defaults.items()}


def layout(df: DataFrame, partition_col: str, cluster_by: list[str] | None = None) -> DataFrame:
    out = df.hint("rebalance", partition_col)
    if cluster_by:
        out = out.sortWithinPartitions(partition_col, *cluster_by)
    return out


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    mode: str = "append",
    codec: str = "snappy",
    cluster_by: list[str] | None = None,
    dynamic: bool = False,
) -> None:
    """Hive-style ``<partition_col>=<value>/`` Parquet write.

    ``dynamic=True`` with ``mode="overwrite"`` replaces only the partitions
    present in ``df`` and leaves every other partition untouched.
    """
    w = layout(df, partition_col, cluster_by).write.mode(mode).option("compression", codec)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(partition_col).parquet(path)


class Written(NamedTuple):
    """Names of the written date folders, and the rows in them."""

    folders: set[str]
    rows: int


def by_range(df: DataFrame, partition_col: str, cluster_by: tuple[str, ...], files: int | None = None) -> DataFrame:
    """Rows spread over tasks by ranges of (date, clustering columns, row hash).

    Without ``files`` adaptive execution merges small neighbouring ranges.
    """
    keys = [partition_col, *cluster_by, F.xxhash64(*df.columns)]
    return df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)


def write_clustered_snapshot(
    df: DataFrame,
    path: str,
    partition_col: str = "event_date",
    cluster_by: tuple[str, ...] = ("event_type", "severity_level"),
    codec: str = "snappy",
    only_dates: list | None = None,
    files: int | None = None,
) -> Written:
    """Truncate-and-load of a whole relation, partitioned and clustered.

    Written with dynamic partition overwrite: the new files are staged and
    swapped in at job commit, so a failed job leaves the previous snapshot
    in place and readers never see an empty table. Dates that are no longer
    in the snapshot are removed afterwards; their list comes from an
    ``observe`` of the written rows (one value per date, no extra pass).

    With ``only_dates`` (dates, None for a missing one) ``df`` holds the rows of these dates,
    and only these are replaced or removed. ``files`` is the number of range tasks (default:
    the session's shuffle partitions, small ones merged). Without clustering columns the layout
    is that of ``write_partitioned``.
    """
    spark = df.sparkSession
    obs = Observation()
    part = F.col(partition_col)
    # Counted above the exchange: its sample reads the rows below once more.
    spread = by_range(df, partition_col, cluster_by, files) if cluster_by else df.hint("rebalance", partition_col)
    counted = spread.observe(
        obs,
        F.collect_set(part.cast("string")).alias("parts"),
        F.count_if(part.isNull()).alias("nulls"),
        F.count(F.lit(1)).alias("rows"),
    )
    writer = counted.sortWithinPartitions(partition_col, *cluster_by).write.mode("overwrite")
    writer = writer.option("compression", codec).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_col).parquet(path)
    got = observed(obs, parts=None, nulls=None, rows=0)
    if got["parts"] is None:
        # No task reported: either nothing was written, or the counters are lost. Ask the input.
        if not df.isEmpty():
            raise RuntimeError(f"{path}: the written dates are unknown; no old date was removed")
        got = {"parts": [], "nulls": 0, "rows": 0}
    keep = {f"{partition_col}={v}" for v in got["parts"]}
    if got["nulls"]:
        keep.add(f"{partition_col}=__HIVE_DEFAULT_PARTITION__")
    mine = None if only_dates is None else {partition_folder(partition_col, d) for d in only_dates}
    root, fs = hadoop_path(spark, path)
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(f"{partition_col}=") or name in keep:
            continue
        if mine is None or name in mine:
            must(fs.delete(st.getPath(), True), f"delete {st.getPath()}")
    return Written(keep, int(got["rows"]))


def partition_folder(partition_col: str, value) -> str:
    return f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def hadoop_path(spark: SparkSession, path: str):
    """``(path, file system)`` of the cluster's file system API."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def must(done: bool, what: str) -> None:
    """File system calls report failure by ``False``."""
    if not done:
        raise OSError(f"could not {what}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_table(spark: SparkSession, path: str, drop_batch_key: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    if drop_batch_key and BATCH_KEY in df.columns:
        df = df.drop(BATCH_KEY)
    return df


def checkpoint_query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps across restarts from one checkpoint."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


# Rows of one file that a micro-batch writes: a batch's fan-out follows its size.
ROWS_PER_FILE = 1_000_000
# Bytes of the records in one file of dead letters (a record may be a whole document).
BYTES_PER_FILE = 128 * 1024 * 1024
# Lets adaptive execution merge and split the partitions of what is persisted.
CACHED_LAYOUT = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
BATCH_LOG = "_batches"
BATCH_LOG_SCHEMA = (
    "batch_id bigint, rows bigint, stored bigint, late bigint, latest timestamp, high_water timestamp, "
    "records bigint, rejected bigint, logged_key string, written_at timestamp"
)
# Keys of the events that copies may still arrive for on time, one snapshot per batch.
RECENT = "_recent"
COMPACTION = "_compaction"


class IdempotentBatchWriter:
    """``foreachBatch`` sink whose replays do not duplicate rows.

    Each micro-batch goes to its own directory
    ``<partition_col>=<date>/batch_key=<query id>-<batch id>/`` written with
    dynamic partition overwrite. A batch that is re-run after a failure
    (same query id, same batch id) rewrites exactly its own directories;
    all other batches stay. The query id comes from the checkpoint, so a
    fresh checkpoint never overwrites the batches of an older one.

    ``dedup_keys`` removes copies inside the batch. With ``against_stored``
    copies of earlier batches are removed too, and the batch is split at the
    largest event time so far minus ``lateness``:

    * on-time rows meet the recent keys, a snapshot that every batch leaves for the
      next one: the keys whose event time is at most twice ``lateness`` old. Its size
      is bounded by the event time it spans; no stored event is read.
    * late rows, where there are any, meet the stored keys of their dates. So a late
      first arrival is stored, and nothing depends on a watermark.

    Copies of an event carry its event time. Without a snapshot (the first batch of a
    checkpoint) all rows meet the stored keys of their dates.

    One row per batch goes to ``<path>/_batches``: rows in, rows stored, late ones, and the
    largest event time of this and all earlier batches, so a batch reads only its
    predecessor's row. ``roll_batch_log`` merges the rows of old batches.

    With ``rejects_path`` the batch is a routed parse (``parse.routed_fires``): rows that are
    kept go to the table, dead letters to ``<rejects_path>/batch_key=<key>/``, from one parse
    and under one key, so a replay rewrites both and they cannot disagree. The log has the
    number of records and of dead letters.
    """

    def __init__(
        self,
        path: str,
        partition_col: str,
        checkpoint: str,
        dedup_keys: list[str] | None = None,
        codec: str = "snappy",
        columns: list[str] | None = None,
        files_per_date: int | None = None,
        preview_rows: int = 0,
        against_stored: bool = False,
        lateness: str | None = None,
        time_col: str = "event_timestamp",
        rejects_path: str | None = None,
    ):
        self.path = path
        self.rejects_path = rejects_path
        self.partition_col = partition_col
        self.checkpoint = checkpoint
        self.dedup_keys = dedup_keys
        self.codec = codec
        self.columns = columns
        self.files_per_date = files_per_date
        self.preview_rows = preview_rows
        self.against_stored = against_stored
        self.lateness = lateness
        self.time_col = time_col
        self._query_id: str | None = None

    def batch_key(self, spark: SparkSession, batch_id: int) -> str:
        if self._query_id is None:
            self._query_id = checkpoint_query_id(spark, self.checkpoint)
        return f"{self._query_id}-{batch_id:010d}"

    def _root(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = self.batch_key(spark, batch_id)
        before = self.batch_key(spark, batch_id - 1) if batch_id else None
        # Read several times: counted, compared with earlier keys, written.
        batch = whole = self._kept(batch)
        try:
            records, rejected = None, None
            if self.rejects_path:
                records, rejected = self._write_rejects(whole, key)
                batch = whole.where(KEPT).drop(RECORD, REASON, KEPT)
            mark = self._high_water(spark, key, before)
            limit = None if mark is None else self._earlier(F.lit(mark).cast("timestamp"), 1)
            counts = self._counts(batch, limit)
            tops = [t for t in (mark, counts["latest"]) if t is not None]
            counts["high_water"] = max(tops) if tops else None
            stored = self._write(self._new_rows(batch, key, before, limit, counts["late"]), key, counts["rows"])
            self._keep_recent(spark, key, before, batch_id, counts["dates"], counts["high_water"])
            self._log(spark, key, batch_id, counts | {"stored": stored, "records": records, "rejected": rejected})
            if self.preview_rows:
                for row in batch.limit(self.preview_rows).collect():
                    log.info("batch %s sample: %s", batch_id, row.asDict())
        finally:
            whole.unpersist()

    def _kept(self, batch: DataFrame) -> DataFrame:
        """The persisted batch, in partitions of bounded bytes.

        A message holds many records, so few landed files give few tasks, whose large
        partitions every later step would read whole. The rows are rebalanced instead:
        partitions follow the batch's bytes, not the number of its files. (Without keys
        they come from a dedup by state, whose shuffle has spread them.)
        """
        if not self.dedup_keys:
            return batch.persist()
        # By the record too, where there is one: bad records have no key and would meet in one partition.
        spread = batch.hint("rebalance", *(c for c in (*self.dedup_keys, RECORD) if c in batch.columns))
        conf = batch.sparkSession.conf
        before = conf.get(CACHED_LAYOUT, None)
        conf.set(CACHED_LAYOUT, "true")
        try:
            return spread.persist()
        finally:
            if before is None:
                conf.unset(CACHED_LAYOUT)
            else:
                conf.set(CACHED_LAYOUT, before)

    def _write_rejects(self, whole: DataFrame, key: str) -> tuple[int, int]:
        """Dead letters of the batch to their own folder; the number of records and of dead letters."""
        bad = F.col(REASON).isNotNull()
        size = F.sum(F.when(bad, F.octet_length(RECORD).cast("long")))
        found = whole.agg(F.count(F.lit(1)).alias("n"), F.count(REASON).alias("bad"), size.alias("bytes")).first()
        folder = f"{self.rejects_path.rstrip('/')}/{BATCH_KEY}={key}"
        if found["bad"] or path_exists(whole.sparkSession, folder):
            letters = whole.where(bad).select(
                F.lit(self.path.rstrip("/").rsplit("/", 1)[-1]).alias("source"),
                F.col(RECORD).alias("record"),
                F.col(REASON).alias("reason"),
                F.current_timestamp().alias("rejected_at"),
            )
            # All tasks look for them, and only the letters move: a coalesce would have the
            # few writing tasks read the whole batch.
            files = max(1, -(-found["bad"] // ROWS_PER_FILE), -(-(found["bytes"] or 0) // BYTES_PER_FILE))
            letters.repartition(files).write.mode("overwrite").option("compression", self.codec).parquet(folder)
        return found["n"], found["bad"]

    def _earlier(self, time: Column, times: int) -> Column:
        for _ in range(times):
            time = time - F.expr(f"INTERVAL {self.lateness}")
        return time

    def _counts(self, batch: DataFrame, limit: Column | None) -> dict:
        has_time = self.time_col in batch.columns
        late = F.count_if(F.col(self.time_col) < limit) if limit is not None and has_time else F.lit(0).cast("long")
        latest = F.max(self.time_col) if has_time else F.lit(None).cast("timestamp")
        # One value per date of the batch.
        dates = F.collect_set(F.coalesce(F.col(self.partition_col).cast("string"), F.lit("")))
        found = batch.agg(
            F.count(F.lit(1)).alias("rows"), late.alias("late"), latest.alias("latest"), dates.alias("dates")
        )
        return found.first().asDict()

    def _high_water(self, spark: SparkSession, key: str, before: str | None):
        """Largest event time of the earlier batches: from the predecessor's log row, found by its path."""
        if not self.lateness:
            return None
        own = None if before is None else f"{self._root(BATCH_LOG)}/{BATCH_KEY}={before}"
        if own is not None and path_exists(spark, own):
            return spark.read.schema(BATCH_LOG_SCHEMA).parquet(own).agg(F.max("high_water")).first()[0]
        if not path_exists(spark, self._root(BATCH_LOG)):
            return None
        # The first batch of a checkpoint, or a log without the predecessor: all of the log.
        rows = read_batch_log(spark, self.path).where(F.col(BATCH_KEY) != key)
        return rows.agg(F.max(F.greatest("latest", "high_water"))).first()[0]

    def _new_rows(self, batch: DataFrame, key: str, before: str | None, limit: Column | None, late: int) -> DataFrame:
        out = batch
        if self.dedup_keys:
            out = out.dropDuplicates(self.dedup_keys)
        if self.columns:
            out = out.select(*self.columns)
        spark = batch.sparkSession
        if not self.against_stored or not path_exists(spark, self.path):
            return out
        recent = None if before is None else f"{self._root(RECENT)}/{BATCH_KEY}={before}"
        if limit is None or recent is None or not path_exists(spark, recent):
            return self._not_stored(out, batch, key)
        is_late = F.coalesce(F.col(self.time_col) < limit, F.lit(True))
        known = spark.read.parquet(recent).select(*self.dedup_keys)
        on_time = out.where(~is_late).join(known, self.dedup_keys, "left_anti")
        if not late and self.time_col in batch.columns:
            return on_time
        return on_time.unionByName(self._not_stored(out.where(is_late), batch.where(is_late), key))

    def _not_stored(self, out: DataFrame, batch: DataFrame, key: str) -> DataFrame:
        """Rows whose key no other batch has stored under a date of ``batch``."""
        spark = batch.sparkSession
        # One value per date; their folders are the only ones read, found by one listing.
        dates = [r[0] for r in batch.select(F.col(self.partition_col).cast("string")).distinct().collect()]
        root, fs = hadoop_path(spark, self.path)
        there = {st.getPath().getName() for st in fs.listStatus(root)}
        names = [f"{self.partition_col}={d or '__HIVE_DEFAULT_PARTITION__'}" for d in dates]
        # Declared: a folder may be empty for a moment.
        keys_only = StructType([out.schema[k] for k in self.dedup_keys])
        known = None
        folders = [self._root(n) for n in names if n in there]
        if folders:
            stored = spark.read.schema(StructType([*keys_only, StructField(BATCH_KEY, StringType())]))
            known = stored.option("basePath", self.path).parquet(*folders).where(F.col(BATCH_KEY) != key)
            known = known.select(*self.dedup_keys)
        if COMPACTION in there:
            # While a compaction swaps folders, a date's rows are for a moment only in its work folder.
            for day in dates:
                moved = f"{self._root(COMPACTION)}/{day}/old"
                folder, _ = hadoop_path(spark, moved)
                if fs.exists(folder) and len(fs.listStatus(folder)):
                    keys = spark.read.schema(keys_only).parquet(moved).select(*self.dedup_keys)
                    known = keys if known is None else known.unionByName(keys)
        return out if known is None else out.join(known, self.dedup_keys, "left_anti")

    def _keep_recent(self, spark: SparkSession, key: str, before: str | None, batch_id: int, dates: list, mark) -> None:
        """The snapshot for the next batch: the last one's keys and this batch's, without those too old by now."""
        if not (self.against_stored and self.lateness and mark is not None):
            return
        since = self._earlier(F.lit(mark).cast("timestamp"), 2)
        wanted = [*self.dedup_keys, self.time_col]
        old = None if before is None else f"{self._root(RECENT)}/{BATCH_KEY}={before}"
        keys = self._stored_of(spark, key, dates, wanted)
        if old is not None and path_exists(spark, old):
            past = spark.read.parquet(old).select(*wanted)
        else:
            # No snapshot yet: the stored keys of the time that it has to span.
            past = read_table(spark, self.path).where(F.col(self.partition_col) >= F.to_date(since)).select(*wanted)
        if keys is not None:
            past = past.unionByName(keys)
        kept = past.where(F.col(self.time_col) >= since).dropDuplicates(self.dedup_keys)
        kept.write.mode("overwrite").option("compression", self.codec).parquet(f"{self._root(RECENT)}/{BATCH_KEY}={key}")
        if batch_id > 1:
            # A replay of this batch needs the snapshot before it, and none older.
            gone, fs = hadoop_path(spark, f"{self._root(RECENT)}/{BATCH_KEY}={self.batch_key(spark, batch_id - 2)}")
            fs.delete(gone, True)

    def _stored_of(self, spark: SparkSession, key: str, dates: list[str], columns: list[str]) -> DataFrame | None:
        """What this batch has just written (nothing, where every row was a copy)."""
        names = (f"{self.partition_col}={d or '__HIVE_DEFAULT_PARTITION__'}" for d in dates)
        folders = [f for n in names if path_exists(spark, f := f"{self._root(n)}/{BATCH_KEY}={key}")]
        if not folders:
            return None
        return spark.read.option("basePath", self.path).parquet(*folders).select(*columns)

    def _write(self, out: DataFrame, key: str, rows: int) -> int:
        obs = Observation()
        out = out.observe(obs, F.count(F.lit(1)).alias("n")).withColumn(BATCH_KEY, F.lit(key))
        # Adaptive execution does not run inside a micro-batch, so a plain
        # shuffle on the date would send a live batch (nearly all rows share
        # today's date) to a single task. Every date is spread over salted
        # tasks, as many as the batch's rows need (or ``files_per_date``).
        salts = self.files_per_date or -(-rows // ROWS_PER_FILE) or 1
        salt = F.pmod(F.xxhash64(*out.columns), F.lit(salts))
        (
            out.repartition(F.col(self.partition_col), salt)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", self.codec)
            .partitionBy(self.partition_col, BATCH_KEY)
            .parquet(self.path)
        )
        return int(observed(obs, n=0)["n"])

    def _log(self, spark: SparkSession, key: str, batch_id: int, counts: dict) -> None:
        row = (batch_id, counts["rows"], counts["stored"], counts["late"], counts["latest"], counts["high_water"])
        row += (counts["records"], counts["rejected"], key)
        schema = (
            "batch_id bigint, rows bigint, stored bigint, late bigint, latest timestamp, high_water timestamp, "
            f"records bigint, rejected bigint, {BATCH_KEY} string"
        )
        (
            spark.createDataFrame([row], schema)
            .withColumn("written_at", F.current_timestamp())
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_KEY)
            .parquet(f"{self.path.rstrip('/')}/{BATCH_LOG}")
        )


ROLLED = "rolled-"
# Batches whose log rows stay in folders of their own.
LOG_KEEP = 100


def read_batch_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch of the table at ``path``, from single and merged log files."""
    root = f"{path.rstrip('/')}/{BATCH_LOG}"
    rows = spark.read.schema(f"{BATCH_LOG_SCHEMA}, {BATCH_KEY} string").parquet(root)
    rows = rows.withColumn(BATCH_KEY, F.coalesce("logged_key", BATCH_KEY)).drop("logged_key")
    # A roll that stopped half-way leaves rows twice, never none.
    return rows.dropDuplicates([BATCH_KEY])


def roll_batch_log(spark: SparkSession, path: str, keep: int = LOG_KEEP) -> int:
    """Merge the log rows of all but the newest ``keep`` batches of every query into one file.

    The merged copy is written aside and moved in, then the single folders go; a stop in
    between leaves rows twice, which ``read_batch_log`` removes. Returns the number of
    folders merged. The predecessor's row of a running query stays where it is.
    """
    root = f"{path.rstrip('/')}/{BATCH_LOG}"
    folder, fs = hadoop_path(spark, root)
    if not fs.exists(folder):
        return 0
    prefix = f"{BATCH_KEY}="
    names = sorted(st.getPath().getName() for st in fs.listStatus(folder) if st.getPath().getName().startswith(prefix))
    merged = [n for n in names if n.startswith(prefix + ROLLED)]
    by_query: dict[str, list[str]] = {}
    for name in names:
        if name not in merged:
            by_query.setdefault(name.rsplit("-", 1)[0], []).append(name)
    old = [n for found in by_query.values() for n in found[: max(0, len(found) - keep)]]
    if not old:
        return 0
    rows = spark.read.schema(f"{BATCH_LOG_SCHEMA}, {BATCH_KEY} string").option("basePath", root)
    rows = rows.parquet(*(f"{root}/{n}" for n in old + merged))
    rows = rows.withColumn("logged_key", F.coalesce("logged_key", BATCH_KEY)).drop(BATCH_KEY)
    work = f"{root}/_rolling"
    rows.dropDuplicates(["logged_key"]).coalesce(1).write.mode("overwrite").parquet(work)
    _move(spark, work, f"{root}/{prefix}{ROLLED}{uuid.uuid4().hex[:12]}")
    for name in old + merged:
        must(fs.delete(hadoop_path(spark, f"{root}/{name}")[0], True), f"delete {name}")
    return len(old)


TARGET_FILE_BYTES = 256 * 1024 * 1024
COMPACTED = "compacted-"


def compact_date(
    spark: SparkSession,
    path: str,
    partition_col: str,
    day: str,
    files: int | None = None,
    codec: str = "snappy",
) -> int:
    """Merge the micro-batch folders of one closed date into a few files.

    ``files`` defaults to the date's bytes on disk / 256 MB (read from the
    file system, no data pass), so a large date is written by as many tasks.

    Only for dates the stream no longer writes. Three steps, each safe to repeat:
    the merged copy is written to ``_compaction/<date>/new`` (readers skip names
    that start with ``_``); the batch folders are moved to ``_compaction/<date>/old``
    and the copy is moved in; then the old folders go. ``recover_compaction`` finishes
    or undoes a run that stopped in between: as long as the copy is not in place, the
    moved folders are put back. Returns the number of rows compacted.
    """
    root = path.rstrip("/")
    recover_compaction(spark, root, partition_col, day)
    part_dir, fs = hadoop_path(spark, f"{root}/{partition_col}={day}")
    work = f"{root}/{COMPACTION}/{day}"
    if files is None:
        size = fs.getContentSummary(part_dir).getLength()
        files = max(1, -(-size // TARGET_FILE_BYTES))
    old_names = [st.getPath().getName() for st in fs.listStatus(part_dir) if st.isDirectory()]
    old_names = [n for n in old_names if n.startswith(f"{BATCH_KEY}=")]
    if not old_names:
        return 0
    rows = spark.read.parquet(*(f"{part_dir.toString()}/{n}" for n in old_names))
    rows.repartition(files).write.mode("overwrite").option("compression", codec).parquet(f"{work}/new")
    # Counted from what was written and from what was read: a short copy stops here.
    n = spark.read.schema(rows.schema).parquet(f"{work}/new").count()
    if n != rows.count():
        raise RuntimeError(f"{part_dir}: the compacted copy has {n} rows, its batches have more")
    old, _ = hadoop_path(spark, f"{work}/old")
    must(fs.mkdirs(old), f"make {old}")
    for name in old_names:
        _move(spark, f"{part_dir.toString()}/{name}", f"{work}/old/{name}")
    _move(spark, f"{work}/new", f"{part_dir.toString()}/{BATCH_KEY}={COMPACTED}{uuid.uuid4().hex[:12]}")
    must(fs.delete(hadoop_path(spark, work)[0], True), f"delete {work}")
    return n


def _move(spark: SparkSession, source: str, target: str) -> None:
    p, fs = hadoop_path(spark, source)
    must(fs.rename(p, hadoop_path(spark, target)[0]), f"move {source} to {target}")


def recover_compaction(spark: SparkSession, path: str, partition_col: str, day: str) -> None:
    """Bring a date back to one full set of folders after a compaction that stopped half-way."""
    root = path.rstrip("/")
    work, fs = hadoop_path(spark, f"{root}/{COMPACTION}/{day}")
    if not fs.exists(work):
        return
    old, new = (hadoop_path(spark, f"{root}/{COMPACTION}/{day}/{x}")[0] for x in ("old", "new"))
    if fs.exists(old) and fs.exists(new):
        # The copy is not in place yet: the batches are still the truth.
        for st in fs.listStatus(old):
            name = st.getPath().getName()
            _move(spark, st.getPath().toString(), f"{root}/{partition_col}={day}/{name}")
    must(fs.delete(work, True), f"delete {work}")


def compact_closed_dates(
    spark: SparkSession,
    path: str,
    partition_col: str,
    before: str,
) -> list[tuple[str, int]]:
    """Compact every date before ``before`` (a ``yyyy-MM-dd`` string) that
    still has more than one batch folder; returns ``(date, rows)`` pairs.

    Dates are found by listing the table's folders (metadata only); each
    compaction is one Spark job over that date. Runs that stopped half-way
    are recovered first, for every date.
    """
    root, fs = hadoop_path(spark, path)
    work, _ = hadoop_path(spark, f"{path.rstrip('/')}/{COMPACTION}")
    if fs.exists(work):
        for st in fs.listStatus(work):
            recover_compaction(spark, path, partition_col, st.getPath().getName())
    done = []
    prefix = f"{partition_col}="
    for st in sorted(fs.listStatus(root), key=lambda x: x.getPath().getName()):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(prefix)):
            continue
        day = name[len(prefix):]
        if not (len(day) == 10 and day < before):
            continue
        batches = [b for b in fs.listStatus(st.getPath()) if b.getPath().getName().startswith(f"{BATCH_KEY}=")]
        if len(batches) > 1:
            done.append((day, compact_date(spark, path, partition_col, day)))
    return done
