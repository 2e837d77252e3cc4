"""Registered queries for exports, retention, quality checks and rejects.

Scenarios (all on data Spark derives from ``events``):

* exports: the target is first loaded from the events before
  ``oracle.FIRST_LOAD_UNTIL`` (a day is still open at that moment), then
  the full marts are exported again with the mode under test;
* retention: the stored ``fires`` / ``earthquakes`` tables are written
  date-partitioned and cleaned as of ``oracle.RETENTION_AS_OF``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tephra import oracle
from tephra.operators import marts, parse, quality, staging
from tephra.plans import export, partials, pipeline, retention
from tephra.plans.queries import shown
from tephra.session import prepare, run_dir
from tephra.sinks.parquet import BATCH_KEY, compact_closed_dates, hadoop_path, read_table, write_clustered_snapshot, write_partitioned
from tephra.sources import testdata

DATASETS = {"fires": "acq_date", "earthquakes": "event_date"}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return testdata.load(spark, sf_dir, "events")


def _marts(events: DataFrame) -> dict[str, DataFrame]:
    f = staging.stg_fires(testdata.fires_table(events))
    q = staging.stg_quakes(testdata.quakes_table(events))
    return {
        "fire_summary": marts.fire_summary(f, ordered=False),
        "earthquake_summary": marts.quake_summary(q, ordered=False),
        "combined_events": marts.combined_events(f, q),
    }


def _first_and_full(spark: SparkSession, sf_dir: str):
    ev = _events(spark, sf_dir)
    first = ev.where(F.col("ts") < F.lit(oracle.FIRST_LOAD_UNTIL).cast("timestamp_ntz"))
    return _marts(first), _marts(ev)


def q_export_hwm(spark, sf_dir):
    """The marks of both summaries after the first load and after the second."""
    first, full = _first_and_full(spark, sf_dir)
    root = run_dir(spark, "export-hwm")
    tables = ("fire_summary", "earthquake_summary")
    out = None
    for load, source in ((1, first), (2, full)):
        export.export_tables(spark, {t: source[t] for t in tables}, root, incremental="append_hwm")
        for t in tables:
            # The value itself: the next load changes the target.
            mark = export.high_water_mark(spark, f"{root}/{t}", "event_date")
            row = spark.createDataFrame([(t, load, mark)], "table_name string, load int, high_water_mark date")
            out = row if out is None else out.unionByName(row)
    return out


def _after_second_export(spark, sf_dir, table: str, incremental: str) -> DataFrame:
    first, full = _first_and_full(spark, sf_dir)
    root = run_dir(spark, f"export-{incremental}")
    export.export_tables(spark, {table: first[table]}, root, incremental="append_hwm")
    export.export_tables(spark, {table: full[table]}, root, incremental=incremental)
    return read_table(spark, f"{root}/{table}")


def q_export_incremental(spark, sf_dir):
    return _after_second_export(spark, sf_dir, "fire_summary", "append_hwm")


def q_export_refresh_dates(spark, sf_dir):
    return _after_second_export(spark, sf_dir, "fire_summary", "refresh_dates")


def _snapshot(spark, sf_dir) -> DataFrame:
    _, full = _first_and_full(spark, sf_dir)
    root = run_dir(spark, "export-snapshot")
    export.export_tables(spark, {"combined_events": full["combined_events"]}, root)
    return read_table(spark, f"{root}/combined_events")


def q_export_snapshot(spark, sf_dir):
    return shown(_snapshot(spark, sf_dir))


def q_export_clustered_layout(spark, sf_dir):
    """Rows per (date, type, severity) of the clustered layout as it lies on disk: how many
    break the order inside their file, how many lie in another date's folder, and how many
    files of the date start before another one ends. Two files a date, on average."""
    full = _first_and_full(spark, sf_dir)[1]["combined_events"]
    root = run_dir(spark, "clustered")
    write_clustered_snapshot(full, root, files=60)
    stored = read_table(spark, root).select(
        "event_date",
        "event_type",
        "severity_level",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    here = F.struct("event_type", "severity_level")
    # One file at a time: its size is bounded by the writer.
    before = F.lag(here).over(Window.partitionBy("file").orderBy("at"))
    stored = stored.withColumn("out_of_order", F.coalesce(here < before, F.lit(False)))
    folder = F.regexp_extract("file", "event_date=([^/]+)/", 1)
    # One row per file; ranges may meet in one value.
    ranges = stored.groupBy("event_date", "file").agg(F.min(here).alias("lo"), F.max(here).alias("hi"))
    ended = F.max("hi").over(Window.partitionBy("event_date").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("overlaps", F.coalesce(F.col("lo") < ended, F.lit(False)))
    ranges = ranges.groupBy("event_date").agg(F.count_if("overlaps").alias("files_overlapping"))
    counts = stored.groupBy("event_date", "event_type", "severity_level").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("out_of_order").alias("rows_out_of_order"),
        F.count_if(folder != F.col("event_date").cast("string")).alias("rows_in_wrong_folder"),
    )
    return counts.join(ranges, "event_date")


def q_export_status(spark, sf_dir):
    first, full = _first_and_full(spark, sf_dir)
    root = run_dir(spark, "export-status")
    export.export_tables(spark, first, root, incremental="append_hwm")
    log = export.export_tables(spark, full, root, incremental="append_hwm")
    return log.select(F.col("table").alias("table_name"), "mode", "status", "rows")


def _write_event_tables(spark, sf_dir) -> str:
    ev = _events(spark, sf_dir)
    base = run_dir(spark, "retention")
    write_partitioned(testdata.fires_table(ev), f"{base}/fires", "acq_date")
    write_partitioned(testdata.quakes_table(ev), f"{base}/earthquakes", "event_date")
    for name in oracle.ODD_FOLDERS:
        folder, fs = hadoop_path(spark, f"{base}/fires/{name}")
        fs.mkdirs(folder)
    return base


def q_retention_plan(spark, sf_dir):
    base = _write_event_tables(spark, sf_dir)
    plan = retention.retention_plan(spark, base, DATASETS, as_of=oracle.RETENTION_AS_OF)
    plan = retention.with_row_counts(plan, spark, base, DATASETS)
    rows = F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    day = F.coalesce(F.col("partition_date").cast("string"), F.lit("")).alias("partition_date")
    return plan.select("dataset", "partition", day, "action", rows)


def _retained(spark, sf_dir) -> tuple[str, DataFrame]:
    """Tables after the retention job, and its report."""
    base = _write_event_tables(spark, sf_dir)
    # The plan is materialised before anything is deleted.
    plan = retention.retention_plan(spark, base, DATASETS, as_of=oracle.RETENTION_AS_OF).checkpoint()
    return base, retention.retention_report(plan, retention.apply_retention(spark, plan, base))


def q_retention_report(spark, sf_dir):
    """Apply retention, then report per dataset, with the rows left on disk."""
    base, report = _retained(spark, sf_dir)
    left = None
    for name, key in DATASETS.items():
        files = spark.read.option("basePath", f"{base}/{name}").parquet(f"{base}/{name}/{key}=20*")
        n = files.agg(F.count(F.lit(1)).alias("rows_remaining"))
        n = n.select(F.lit(name).alias("dataset"), "rows_remaining")
        left = n if left is None else left.unionByName(n)
    return retention.merge_on(report, left, ["dataset"]).select(
        "dataset",
        "partitions_scanned",
        "partitions_deleted",
        "cutoff_date",
        "errors",
        F.array_join("deleted", ",").alias("deleted"),
        "rows_remaining",
    )


def q_retention_status(spark, sf_dir):
    """Totals and exit status of the whole retention job."""
    status = retention.retention_status(_retained(spark, sf_dir)[1])
    return status.select("partitions_scanned", "partitions_deleted", "errors", "status")


def q_retention_dry_run(spark, sf_dir):
    """A dry run over both tables and one that is missing: what would go, its size, and that nothing went."""
    base = _write_event_tables(spark, sf_dir)
    datasets = {**DATASETS, oracle.MISSING_DATASET: "event_date"}
    plan = retention.retention_plan(spark, base, datasets, as_of=oracle.RETENTION_AS_OF).checkpoint()
    report = retention.retention_report(plan, retention.apply_retention(spark, plan, base, dry_run=True))
    after = retention.with_row_counts(plan, spark, base, DATASETS)
    # Megabytes have two digits; a folder without files has none.
    rounded = F.abs(F.col("size_mb") * 1024 * 1024 - F.col("bytes")) <= 0.005 * 1024 * 1024
    kept = after.groupBy("dataset").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_remaining"),
        F.count_if(rounded & (F.col("bytes") > 0)).alias("partitions_with_size"),
    )
    return retention.merge_on(report, kept, ["dataset"]).select(
        "dataset", "partitions_scanned", "partitions_deleted", "errors", "rows_remaining", "partitions_with_size"
    )


def q_refresh_views(spark, sf_dir):
    """Refresh the stored dashboard relations, then read them by name in another session."""
    ev = _events(spark, sf_dir)
    base = run_dir(spark, "views")
    write_partitioned(testdata.fires_table(ev), f"{base}/fires", "acq_date")
    write_partitioned(testdata.quakes_table(ev), f"{base}/earthquakes", "event_date")
    # A schema of its own, so that runs in one catalog never collide.
    schema = f"tephra_{base.rsplit('-', 1)[-1]}"
    pipeline.refresh_views(spark, base, f"{base}/marts", as_of=oracle.AS_OF, schema=schema)
    other = prepare(spark.newSession())
    days = "count(*) AS n_rows, cast(min(event_date) AS STRING) AS first_day, cast(max(event_date) AS STRING) AS last_day"
    names = ("mv_combined_events", "mv_looker_fire_metrics", "mv_looker_earthquake_metrics")
    parts = [f"SELECT '{n}' AS relation, {days} FROM {schema}.{n}" for n in names]
    parts.append(
        "SELECT 'v_looker_realtime_summary', fires_7d + earthquakes_7d, alert_status, cast(fires_24h AS STRING) "
        f"FROM {schema}.v_looker_realtime_summary"
    )
    return other.sql(" UNION ALL ".join(parts))


def q_refresh_changed_dates(spark, sf_dir):
    """Per date of every stored relation: its rows after a second load and a refresh, and whether
    the refresh replaced the date's files."""
    ev = _events(spark, sf_dir)
    base = run_dir(spark, "changed-dates")
    early = F.col("ts") < F.lit(oracle.FIRST_LOAD_UNTIL).cast("timestamp_ntz")
    target, names, key = f"{base}/marts", None, ["table_name", "event_date", "file"]
    # The second load reaches back: it starts inside a day of the first.
    for part in (ev.where(early), ev.where(~early)):
        write_partitioned(testdata.fires_table(part), f"{base}/fires", "acq_date")
        write_partitioned(testdata.quakes_table(part), f"{base}/earthquakes", "event_date")
        log = pipeline.refresh_models(spark, base, target)
        files = None
        for table in log.select("table_name").distinct().collect():
            stored = read_table(spark, f"{target}/{table[0]}")
            one = stored.select(F.lit(table[0]).alias("table_name"), "event_date", F.col("_metadata.file_name").alias("file"))
            one = one.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
            files = one if files is None else files.unionByName(one)
        if names is None:
            # A task's files have one name in all the dates it writes.
            names = files.select(*key).checkpoint().withColumn("old", F.lit(True))
    return files.join(names, key, "left").groupBy("table_name", "event_date").agg(
        F.sum("n_rows").alias("n_rows"), F.max(F.col("old").isNull()).alias("replaced")
    )


def _merged(partial, read):
    """A mart merged from partial aggregates, brought up to date after each of three loads, of
    which the last reaches back to every date, and after a compaction of the first dates."""

    def run(spark, sf_dir):
        ev = _events(spark, sf_dir)
        base = run_dir(spark, "partials")
        one, key = partial(), DATASETS[partial().source]
        make = testdata.fires_table if one.source == "fires" else testdata.quakes_table
        late = F.hour("ts") < 6
        early = F.col("ts") < F.lit(oracle.FIRST_LOAD_UNTIL).cast("timestamp_ntz")
        path = f"{base}/{one.source}"
        for n, part in enumerate((early & ~late, ~early & ~late, late)):
            rows = make(ev.where(part)).withColumn(BATCH_KEY, F.lit(f"load-{n}"))
            rows.repartition(key).write.mode("append").partitionBy(key, BATCH_KEY).parquet(path)
            partials.update(spark, base, f"{base}/marts", one)
        compact_closed_dates(spark, path, key, oracle.COMPACT_BEFORE)
        partials.update(spark, base, f"{base}/marts", one)
        return read(spark, f"{base}/marts")

    return run


def q_dq_checks(spark, sf_dir):
    ev = _events(spark, sf_dir)
    f = staging.stg_fires(testdata.fires_table(ev))
    q = staging.stg_quakes(testdata.quakes_table(ev))
    tables = {
        "stg_fires": f,
        "stg_earthquakes": q,
        "fire_summary": marts.fire_summary(f, ordered=False),
        "earthquake_summary": marts.quake_summary(q, ordered=False),
        "combined_events": marts.combined_events(f, q),
    }
    return quality.check_marts(tables)


def q_rejects(spark, sf_dir):
    """Dead letters of both feeds, when every message carries a bad record."""
    ev = _events(spark, sf_dir)
    _, fire_rej = parse.split_fires(testdata.fire_payloads(ev, junk=True))
    quake_rej = parse.quake_rejects(testdata.quake_payloads(ev, junk=True))
    return (
        fire_rej.unionByName(quake_rej)
        .groupBy("source", "reason")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def q_batch_preview(spark, sf_dir):
    """The five-row preview the original job printed per batch, made
    deterministic: the first five detections by event id (a top-k: each
    task keeps its own five, the driver merges them)."""
    fires = parse.parse_fires(testdata.fire_payloads(_events(spark, sf_dir)))
    return fires.orderBy("event_id").limit(5)


def maintenance_queries() -> dict:
    return {
        "export_hwm": q_export_hwm,
        "export_incremental": q_export_incremental,
        "export_refresh_dates": q_export_refresh_dates,
        "export_snapshot": q_export_snapshot,
        "export_clustered_layout": q_export_clustered_layout,
        "export_status": q_export_status,
        "retention_plan": q_retention_plan,
        "retention_report": q_retention_report,
        "retention_status": q_retention_status,
        "retention_dry_run": q_retention_dry_run,
        "refresh_views": q_refresh_views,
        "refresh_changed_dates": q_refresh_changed_dates,
        "fire_summary_merged": _merged(partials.fire_summary_partial, partials.fire_summary),
        "quake_summary_merged": _merged(partials.quake_summary_partial, partials.quake_summary),
        "fire_clusters_merged": _merged(
            partials.fire_clusters_partial, lambda spark, root: shown(partials.fire_clusters(spark, root))
        ),
        "dq_checks": q_dq_checks,
        "rejects": q_rejects,
        "batch_preview": q_batch_preview,
    }
