"""Command line for the scheduled jobs (run through spark-submit).

    spark-submit --py-files tephra.zip tephra/__main__.py ingest --base <shared>/events --kafka broker:9092
    python -m tephra ingest          --base /data/events --fires-dir /landing/fires \\
                                     --quakes-dir /landing/quakes --available-now
    python -m tephra rebuild         --base /data/events --target /data/marts
    python -m tephra export          --base /data/events --target /data/export
    python -m tephra retention       --base /data/events --dry-run
    python -m tephra compact         --base /data/events --before 2024-01-30

``--master`` is only for local runs; on a cluster spark-submit decides.
"""

from __future__ import annotations

import argparse
import json
import sys

from tephra.session import build_session, prepare


def _session(args):
    """The submitted settings stay: nothing but the runtime settings is forced."""
    spark = build_session(
        master=args.master, app_name=f"tephra-{args.cmd}", shuffle_partitions=args.shuffle_partitions
    )
    return prepare(spark)


def cmd_ingest(spark, args) -> int:
    from tephra.sources import kafka, landed
    from tephra.streaming import pipelines

    if args.kafka:
        bounds = {"max_offsets_per_trigger": args.max_offsets_per_trigger, "min_partitions": args.min_partitions}
        fires = kafka.fire_messages(spark, args.kafka, **bounds)
        quakes = kafka.quake_messages(spark, args.kafka, **bounds)
    else:
        fires = landed.stream_messages(spark, args.fires_dir, args.format, args.max_files_per_trigger)
        quakes = landed.stream_messages(spark, args.quakes_dir, args.format, args.max_files_per_trigger)
    trigger = "available_now" if args.available_now else args.trigger
    queries = pipelines.start_both(
        fires,
        quakes,
        args.base,
        trigger=trigger,
        dedup=args.dedup,
        rejects=args.rejects,
        fires_watermark=args.fires_watermark,
        quakes_watermark=args.quakes_watermark,
        codec=args.codec,
        files_per_date=args.files_per_date,
        skew_salts=args.skew_salts,
        max_future=args.max_future,
    )
    if args.available_now:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"{q.name} failed: {q.exception()}")
        for name in ("fires_ingest", "earthquakes_ingest"):
            pipelines.batch_reports(spark).wait(name)
    else:
        pipelines.run_forever(queries)
    return 0


def _stored_staging(spark, base):
    from tephra.operators import staging
    from tephra.sinks.parquet import read_table

    return (
        staging.stg_fires(read_table(spark, f"{base}/fires")),
        staging.stg_quakes(read_table(spark, f"{base}/earthquakes")),
    )


def cmd_rebuild(spark, args) -> int:
    from tephra.plans import pipeline

    names = pipeline.refresh_views(
        spark,
        args.base,
        args.target,
        as_of=args.as_of,
        schema=args.schema,
        refresh_minutes=args.refresh_minutes,
        full=args.full,
        merge_batches=args.merge_batches,
    )
    print(json.dumps(names))
    return 0


def cmd_export(spark, args) -> int:
    from tephra.operators import marts
    from tephra.plans import export, pipeline

    if args.mode == "changed_dates":
        log = pipeline.refresh_models(spark, args.base, args.target, dashboards=False, merge_batches=args.merge_batches)
        for r in log.collect():
            print(json.dumps(r.asDict(), default=str))
        return 0
    stg_f, stg_q = _stored_staging(spark, args.base)
    if args.mode == "refresh_dates":
        log = export.refresh_marts(
            spark,
            lambda d: marts.build_marts(stg_f, stg_q, date_from=d),
            args.target,
            lateness_days=args.lateness_days,
        )
    else:
        tables = {
            t: (lambda d, t=t: marts.build_marts(stg_f, stg_q, date_from=d)[t]) for t in export.TIME_COLUMNS
        }
        log = export.export_tables(spark, tables, args.target, incremental=args.mode)
    for r in log.collect():
        print(json.dumps(r.asDict()))
    return 0


def cmd_retention(spark, args) -> int:
    from tephra.plans import retention

    datasets = {"fires": "acq_date", "earthquakes": "event_date"}
    report = retention.run_retention(
        spark,
        args.base,
        datasets,
        as_of=args.as_of,
        retention_days=args.days,
        buffer_days=args.buffer_days,
        dry_run=args.dry_run,
    )
    rows = report.collect()
    for r in rows:
        print(json.dumps(r.asDict(), default=str))
    return 1 if any(r.errors for r in rows) else 0


def cmd_compact(spark, args) -> int:
    """Compact the dates before ``--before``, never later than the day before the newest
    stored event: the stream still writes to later ones."""
    from pyspark.sql import functions as F

    from tephra.sinks.parquet import BATCH_LOG, compact_closed_dates, path_exists, read_batch_log, roll_batch_log
    from tephra.streaming.pipelines import roll_reports

    for table, key in (("fires", "acq_date"), ("earthquakes", "event_date")):
        path = f"{args.base}/{table}"
        closed = F.date_sub(F.current_date(), 1)
        if path_exists(spark, f"{path}/{BATCH_LOG}"):
            batches = read_batch_log(spark, path)
            newest = batches.agg(F.date_sub(F.to_date(F.max("latest")), 1)).first()[0]
        else:
            newest = spark.range(1).select(closed).first()[0]
        before = min(str(newest), args.before) if args.before else str(newest)
        for day, rows in compact_closed_dates(spark, path, key, before):
            print(json.dumps({"table": table, "date": day, "rows": rows}))
        print(json.dumps({"table": table, "log_folders_merged": roll_batch_log(spark, path)}))
        merged = roll_reports(spark, f"{args.base}/_reports/{table}", args.report_days)
        print(json.dumps({"table": table, "report_files_merged": merged}))
    return 0


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tephra")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, help="default: as submitted")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="stream both feeds into the event tables")
    p.add_argument("--base", required=True)
    p.add_argument("--kafka", help="bootstrap servers; otherwise landed files")
    p.add_argument("--fires-dir")
    p.add_argument("--quakes-dir")
    p.add_argument("--format", default="parquet", choices=["parquet", "text"])
    p.add_argument("--trigger", default="15 minutes")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--dedup", default="sink", choices=["sink", "state", "per_batch"])
    p.add_argument("--rejects", action=argparse.BooleanOptionalAction, default=True, help="dead letters")
    p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: bound of one micro-batch")
    p.add_argument("--min-partitions", type=int, help="Kafka: tasks of one micro-batch, at least")
    p.add_argument("--max-files-per-trigger", type=int, help="landed files: bound of one micro-batch")
    p.add_argument("--files-per-date", type=int, help="default: follows the batch's rows")
    p.add_argument("--skew-salts", type=int, help="dedup=state: salts of a first pass for hot records")
    p.add_argument("--max-future", default="1 day", help="events further ahead go to the dead letters")
    p.add_argument("--fires-watermark", default="1 hour")
    p.add_argument("--quakes-watermark", default="10 minutes")
    p.add_argument("--codec", default="snappy", help="Parquet codec (none, snappy, zstd, ...)")

    p = sub.add_parser("rebuild", help="refresh the changed dates of the marts and of the stored dashboard relations")
    p.add_argument("--base", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--as-of")
    p.add_argument("--schema", default="default", help="catalog schema of the dashboard relations")
    p.add_argument("--refresh-minutes", type=int, default=0, help="leave younger metrics tables as they are")
    p.add_argument("--full", action="store_true", help="every date (after a change of the models' rules)")
    p.add_argument(
        "--merge-batches",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="merge the marts from partial aggregates of the batches, so that only new batches are read",
    )

    p = sub.add_parser("export", help="export the marts")
    p.add_argument("--base", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--mode", default="refresh_dates", choices=["refresh_dates", "append_hwm", "changed_dates"])
    p.add_argument("--lateness-days", type=int, default=1)
    p.add_argument(
        "--merge-batches",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="changed_dates: merge the marts from partial aggregates of the batches, so that only new batches are read",
    )

    p = sub.add_parser("retention", help="drop old date partitions")
    p.add_argument("--base", required=True)
    p.add_argument("--as-of")
    p.add_argument("--days", type=int, default=7)
    p.add_argument("--buffer-days", type=int, default=1)
    p.add_argument("--dry-run", action="store_true")

    p = sub.add_parser("compact", help="merge the batch folders of closed dates")
    p.add_argument("--base", required=True)
    p.add_argument("--before", help="yyyy-MM-dd; never later than the day before the newest event")
    p.add_argument("--report-days", type=int, help="drop batch reports older than that (default: keep all)")
    return ap


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = _session(args)
    handler = {
        "ingest": cmd_ingest,
        "rebuild": cmd_rebuild,
        "export": cmd_export,
        "retention": cmd_retention,
        "compact": cmd_compact,
    }[args.cmd]
    return handler(spark, args)


if __name__ == "__main__":
    sys.exit(main())
