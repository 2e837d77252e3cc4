"""Exports, retention, quality checks and dedup on hand-made tables."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tephra.operators import quality
from tephra.operators.dedup import dedup
from tephra.plans import export, retention
from tephra.sinks.parquet import write_clustered_snapshot, write_partitioned


def summary(spark, rows):
    return spark.createDataFrame(rows, "event_date date, n long").withColumn(
        "event_date", F.col("event_date")
    )


D = dt.date


def test_append_hwm_and_refresh_dates(spark, scratch):
    first = summary(spark, [(D(2024, 1, 1), 5), (D(2024, 1, 2), 1)])  # day 2 still open
    full = summary(spark, [(D(2024, 1, 1), 5), (D(2024, 1, 2), 4), (D(2024, 1, 3), 2)])
    hwm_path, ref_path = f"{scratch}/hwm", f"{scratch}/refresh"
    assert export.high_water_mark(spark, hwm_path, "event_date") is None
    r = export.export_append_hwm(spark, first, hwm_path, "event_date")
    assert r["rows"] == 2 and r["high_water_mark"] is None  # full load
    r = export.export_append_hwm(spark, full, hwm_path, "event_date")
    assert r["high_water_mark"] == D(2024, 1, 2) and r["rows"] == 1
    got = {(x.event_date, x.n) for x in spark.read.parquet(hwm_path).collect()}
    assert got == {(D(2024, 1, 1), 5), (D(2024, 1, 2), 1), (D(2024, 1, 3), 2)}  # day 2 frozen

    export.export_refresh_dates(spark, first, ref_path)
    r = export.export_refresh_dates(spark, full, ref_path, lateness_days=0)
    assert r["rows"] == 2
    got = {(x.event_date, x.n) for x in spark.read.parquet(ref_path).collect()}
    assert got == {(D(2024, 1, 1), 5), (D(2024, 1, 2), 4), (D(2024, 1, 3), 2)}


def test_export_tables_logs_and_raises(spark, scratch):
    marts = {"fire_summary": summary(spark, [(D(2024, 1, 1), 1)])}
    log = export.export_tables(spark, marts, scratch).collect()
    assert [(r.table, r.status, r.rows) for r in log] == [("fire_summary", "SUCCESS", 1)]
    bad = {"fire_summary": spark.createDataFrame([(1,)], "x int")}  # no event_date column
    with pytest.raises(RuntimeError):
        export.export_tables(spark, bad, f"{scratch}/b")
    logged = spark.read.parquet(f"{scratch}/b/_export_log").collect()
    assert [r.status for r in logged] == ["FAILED"]


def test_clustered_snapshot_layout(spark, scratch):
    rows = [
        (D(2024, 1, 1 + i % 3), "fire" if i % 2 else "earthquake", "severe" if i % 5 else "moderate", i)
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "event_date date, event_type string, severity_level string, i int")
    write_clustered_snapshot(df, f"{scratch}/t")
    write_clustered_snapshot(df.limit(10), f"{scratch}/t")  # truncate-and-load
    assert spark.read.parquet(f"{scratch}/t").count() == 10
    dirs = sorted(d for d in os.listdir(f"{scratch}/t".replace("file:", "")) if d.startswith("event_date="))
    assert dirs and all(d.startswith("event_date=2024-01-0") for d in dirs)


def _tree(spark, base):
    df = spark.createDataFrame(
        [(D(2024, 1, d), d) for d in range(10, 16)], "acq_date date, v int"
    )
    write_partitioned(df, f"{base}/fires", "acq_date")
    root = f"{base}/fires".replace("file:", "")
    for extra in ("acq_date=bad", "acq_date=__HIVE_DEFAULT_PARTITION__", "notes", "other=2024-01-01"):
        os.makedirs(f"{root}/{extra}", exist_ok=True)
        with open(f"{root}/{extra}/f.txt", "w") as fh:
            fh.write("x")


def test_retention_plan_cutoff_and_errors(spark, scratch):
    _tree(spark, scratch)
    plan = retention.retention_plan(spark, scratch, {"fires": "acq_date"}, as_of="2024-01-20 02:00:00")
    actions = {r.partition: r.action for r in plan.collect()}
    assert actions["acq_date=2024-01-12"] == "delete"
    assert actions["acq_date=2024-01-13"] == "keep"
    assert actions["acq_date=bad"] == "error"
    assert actions["acq_date=__HIVE_DEFAULT_PARTITION__"] == "error"
    assert actions["notes"] == "skip" and actions["other=2024-01-01"] == "skip"
    # Exactly at midnight the cutoff equals the partition date: strict "<" keeps it.
    plan0 = retention.retention_plan(spark, scratch, {"fires": "acq_date"}, as_of="2024-01-20 00:00:00")
    actions0 = {r.partition: r.action for r in plan0.collect()}
    assert actions0["acq_date=2024-01-12"] == "keep" and actions0["acq_date=2024-01-11"] == "delete"


def test_apply_retention_and_report(spark, scratch):
    _tree(spark, scratch)
    plan = retention.retention_plan(
        spark, scratch, {"fires": "acq_date", "missing": "event_date"}, as_of="2024-01-20 02:00:00"
    ).checkpoint()
    dry = retention.apply_retention(spark, plan, scratch, dry_run=True)
    def dated():
        return spark.read.option("basePath", f"{scratch}/fires").parquet(f"{scratch}/fires/acq_date=2024-*")

    assert len(dry) == 3 and dated().count() == 6
    assert all(r["done"] for r in dry)
    done = retention.apply_retention(spark, plan, scratch)
    assert sorted(r["partition"] for r in done) == [f"acq_date=2024-01-{d}" for d in (10, 11, 12)]
    left = dated().select("v").collect()
    assert sorted(r.v for r in left) == [13, 14, 15]
    rep = {r.dataset: r for r in retention.retention_report(plan).collect()}
    assert rep["fires"].partitions_scanned == 10 and rep["fires"].partitions_deleted == 3
    assert rep["fires"].errors == 2 and rep["fires"].bytes_freed > 0
    assert rep["missing"].partitions_scanned == 0 and rep["missing"].errors == 1
    status = retention.retention_status(retention.retention_report(plan)).first()
    assert status.status == 1


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), 1, "low"), (D(2024, 1, 1), 1, "low"), (None, 30, "bogus")],
        "event_date date, hour int, cat string",
    )
    checks = [
        ("not_null", ["event_date"], None),
        ("unique", ["event_date", "hour"], None),
        ("accepted_values", ["cat"], ["low", "high"]),
        ("range", ["hour"], (0, 23)),
    ]
    got = {(r.check, r.columns): r.failures for r in quality.run_checks(df, "t", checks).collect()}
    assert got == {
        ("not_null", "event_date"): 1,
        ("unique", "event_date,hour"): 1,
        ("accepted_values", "cat"): 1,
        ("range", "hour"): 1,
    }


def test_dedup_keep_first_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("a", 1, "z"), ("b", 2, "w")], "k string, o int, v string"
    )
    first = sorted(tuple(r) for r in dedup(df, ["k"], keep="first", order_by=["o"]).collect())
    last = sorted(tuple(r) for r in dedup(df, ["k"], keep="last", order_by=["o"]).collect())
    assert first == [("a", 1, "y"), ("b", 2, "w")]
    assert last == [("a", 3, "x"), ("b", 2, "w")]
    assert dedup(df, ["k"]).count() == 2


def test_refresh_marts_prunes_old_partitions(spark, scratch):
    from tephra.operators import marts, staging
    from tephra.sinks.parquet import read_table
    from tephra.sources import testdata

    ev = testdata.load(spark, "/root/testdata/sf0.001", "events")
    write_partitioned(testdata.fires_table(ev), f"{scratch}/fires", "acq_date")
    write_partitioned(testdata.quakes_table(ev), f"{scratch}/earthquakes", "event_date")
    stg_f = staging.stg_fires(read_table(spark, f"{scratch}/fires"))
    stg_q = staging.stg_quakes(read_table(spark, f"{scratch}/earthquakes"))

    def build(date_from):
        return marts.build_marts(stg_f, stg_q, date_from=date_from)

    first = export.refresh_marts(spark, build, f"{scratch}/out").collect()
    assert {r.table: r.high_water_mark for r in first} == {
        "fire_summary": None, "earthquake_summary": None, "combined_events": None
    }
    again = {r.table: r for r in export.refresh_marts(spark, build, f"{scratch}/out").collect()}
    assert again["fire_summary"].high_water_mark == "2024-01-30"
    full = marts.fire_summary(stg_f, ordered=False)
    assert again["fire_summary"].rows == full.where("event_date >= DATE'2024-01-29'").count()
    out = spark.read.parquet(f"{scratch}/out/fire_summary")
    assert out.count() == full.count()
    # The refresh plan reads only the last days of the stored fires table.
    plan = build(D(2024, 1, 29))["fire_summary"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-29" in plan


def test_snapshot_replaces_dates_and_keeps_null_partition(spark, scratch):
    schema = "event_date date, event_type string, severity_level string, i int"
    old = spark.createDataFrame(
        [(D(2024, 1, 1), "fire", "severe", 1), (D(2024, 1, 2), "fire", "severe", 2), (None, "fire", "moderate", 3)],
        schema,
    )
    new = spark.createDataFrame(
        [(D(2024, 1, 2), "fire", "severe", 20), (None, "fire", "moderate", 30)], schema
    )
    write_clustered_snapshot(old, f"{scratch}/s")
    write_clustered_snapshot(new, f"{scratch}/s")
    got = sorted((r.i, r.event_date) for r in spark.read.parquet(f"{scratch}/s").collect())
    assert got == [(20, D(2024, 1, 2)), (30, None)]


def test_apply_retention_through_the_catalog(spark, scratch):
    loc = f"{scratch}/cat_fires"
    spark.sql("DROP TABLE IF EXISTS ret_fires")
    spark.sql(
        f"CREATE TABLE ret_fires (v INT, acq_date DATE) USING parquet PARTITIONED BY (acq_date) LOCATION '{loc}'"
    )
    spark.createDataFrame(
        [(d, D(2024, 1, d)) for d in range(10, 16)], "v int, acq_date date"
    ).write.insertInto("ret_fires")
    base = scratch
    plan = retention.retention_plan(spark, base, {"cat_fires": "acq_date"}, as_of="2024-01-20 02:00:00").checkpoint()
    done = retention.apply_retention(spark, plan, base, tables={"cat_fires": "ret_fires"})
    assert len(done) == 3
    assert sorted(r.v for r in spark.table("ret_fires").collect()) == [13, 14, 15]
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS ret_fires").collect()]
    assert parts == ["acq_date=2024-01-13", "acq_date=2024-01-14", "acq_date=2024-01-15"]
    spark.sql("DROP TABLE ret_fires")


def test_empty_old_folders_are_dropped_and_failures_do_not_stop(spark, scratch, monkeypatch):
    _tree(spark, scratch)
    os.makedirs(f"{scratch}/fires/acq_date=2023-12-31".replace("file:", ""))
    plan = retention.retention_plan(spark, scratch, {"fires": "acq_date"}, as_of="2024-01-20 02:00:00").checkpoint()
    real = retention._drop

    def drop(spark, r, *rest):
        if r.partition.endswith("01-11"):
            raise OSError("disk on fire")
        real(spark, r, *rest)

    monkeypatch.setattr(retention, "_drop", drop)
    outcome = retention.apply_retention(spark, plan, scratch)
    rep = retention.retention_report(plan, outcome).first()
    assert rep.deleted == ["acq_date=2023-12-31", "acq_date=2024-01-10", "acq_date=2024-01-12"]
    assert rep.partitions_deleted == 3 and rep.errors == 3
    assert [e for e in rep.error_texts if "disk on fire" in e] == ["acq_date=2024-01-11: OSError: disk on fire"]
    left = os.listdir(f"{scratch}/fires".replace("file:", ""))
    assert "acq_date=2024-01-11" in left and "acq_date=2023-12-31" not in left


def _batch_folders(spark, scratch):
    rows = spark.createDataFrame([(D(2024, 1, 1), f"b{i % 3}", i) for i in range(30)], "acq_date date, batch_key string, v int")
    rows.write.partitionBy("acq_date", "batch_key").parquet(f"{scratch}/t")


def _values(spark, scratch):
    return sorted(r.v for r in spark.read.parquet(f"{scratch}/t").collect())


@pytest.mark.parametrize("broken_at", range(5))
def test_a_broken_compaction_loses_no_row(spark, scratch, monkeypatch, broken_at):
    """Stop before each of the moves and before the clean-up; the next run brings everything back."""
    from tephra.sinks import parquet

    _batch_folders(spark, scratch)
    calls, real_move, real_must = [0], parquet._move, parquet.must

    def step(run):
        if calls[0] == broken_at:
            raise OSError("stopped")
        calls[0] += 1
        return run()

    monkeypatch.setattr(parquet, "_move", lambda *a: step(lambda: real_move(*a)))
    monkeypatch.setattr(
        parquet, "must", lambda done, what: step(lambda: None) if what.startswith("delete") else real_must(done, what)
    )
    try:
        parquet.compact_date(spark, f"{scratch}/t", "acq_date", "2024-01-01")
    except OSError:
        pass
    monkeypatch.undo()
    done = parquet.compact_closed_dates(spark, f"{scratch}/t", "acq_date", "2024-02-01")
    assert _values(spark, scratch) == list(range(30))
    folders = os.listdir(f"{scratch}/t/acq_date=2024-01-01".replace("file:", ""))
    assert len([f for f in folders if f.startswith("batch_key=")]) == 1, (done, folders)
    assert not os.path.exists(f"{scratch}/t/_compaction/2024-01-01".replace("file:", ""))


def test_unknown_counters_delete_nothing(spark, scratch, monkeypatch):
    from tephra.sinks import parquet

    schema = "event_date date, event_type string, severity_level string, i int"
    df = spark.createDataFrame([(D(2024, 1, d), "fire", "severe", d) for d in (1, 2)], schema)
    write_clustered_snapshot(df, f"{scratch}/s")
    monkeypatch.setattr(parquet, "observed", lambda obs, **defaults: defaults)
    with pytest.raises(RuntimeError, match="unknown"):
        write_clustered_snapshot(df.where("i = 2"), f"{scratch}/s")
    monkeypatch.undo()
    assert spark.read.parquet(f"{scratch}/s").count() == 2


def test_a_half_finished_append_is_repeated_without_doubles(spark, scratch, monkeypatch):
    first = summary(spark, [(D(2024, 1, 1), 5), (D(2024, 1, 2), 1)])
    full = summary(spark, [(D(2024, 1, 1), 5), (D(2024, 1, 2), 4), (D(2024, 1, 3), 2), (D(2024, 1, 4), 3)])
    export.export_tables(spark, {"fire_summary": first}, scratch, incremental="append_hwm")
    real = export.write_partitioned

    def half(df, path, *rest, **kw):
        real(df.where("event_date < DATE'2024-01-04'"), path, *rest, **kw)  # one day arrives, then it stops
        raise OSError("stopped")

    monkeypatch.setattr(export, "write_partitioned", half)
    with pytest.raises(RuntimeError):
        export.export_tables(spark, {"fire_summary": full}, scratch, incremental="append_hwm")
    monkeypatch.undo()
    export.export_tables(spark, {"fire_summary": full}, scratch, incremental="append_hwm")
    got = sorted((r.event_date.day, r.n) for r in spark.read.parquet(f"{scratch}/fire_summary").collect())
    assert got == [(1, 5), (2, 1), (3, 2), (4, 3)]
    assert export.unfinished_load(spark, scratch, "fire_summary") is None


def test_future_dates_are_no_mark(spark, scratch):
    df = summary(spark, [(D(2024, 1, 1), 5), (D(2999, 1, 1), 1)])
    df.write.partitionBy("event_date").parquet(f"{scratch}/t")
    assert export.high_water_mark(spark, f"{scratch}/t", "event_date") == D(2024, 1, 1)


def test_export_scans_only_the_days_it_loads(spark, scratch):
    from tephra.operators import marts, staging
    from tephra.sinks.parquet import read_table
    from tephra.sources import testdata

    ev = testdata.load(spark, "/root/testdata/sf0.001", "events")
    write_partitioned(testdata.fires_table(ev), f"{scratch}/fires", "acq_date")
    stg_f = staging.stg_fires(read_table(spark, f"{scratch}/fires"))
    built = []

    def mart(date_from):
        built.append(marts.fire_summary(stg_f, date_from=date_from, ordered=False))
        return built[-1]

    mart(None).where("event_date < DATE'2024-01-20'").write.partitionBy("event_date").parquet(f"{scratch}/out")
    assert export.export_append_hwm(spark, mart, f"{scratch}/out")["high_water_mark"] == D(2024, 1, 19)
    plan = built[-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(acq_date" in plan and "2024-01-19" in plan
    assert spark.read.parquet(f"{scratch}/out").count() == built[0].count()


def test_dedup_carries_each_row_once(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "cast(id AS string) AS v")
    plan = dedup(df, ["k"], keep="first")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "struct" not in plan
    # The first of each key is chosen before the shuffle as well.
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_row_counts_ignore_junk_directories(spark, scratch):
    _tree(spark, scratch)
    plan = retention.retention_plan(spark, scratch, {"fires": "acq_date"}, as_of="2024-01-20 02:00:00")
    counted = {r.partition: r.n_rows for r in retention.with_row_counts(plan, spark, scratch, {"fires": "acq_date"}).collect()}
    assert counted["acq_date=2024-01-12"] == 1 and counted["acq_date=2024-01-15"] == 1
    assert counted["notes"] is None and counted["acq_date=bad"] is None


def test_retention_on_empty_dataset_and_empty_snapshot(spark, scratch):
    os.makedirs(f"{scratch}/empty".replace("file:", ""), exist_ok=True)
    plan = retention.retention_plan(spark, scratch, {"empty": "acq_date"}, as_of="2024-01-20 02:00:00")
    rep = retention.retention_report(plan).collect()
    assert rep == [] or (rep[0].partitions_scanned, rep[0].errors) == (0, 0)
    schema = "event_date date, event_type string, severity_level string, i int"
    write_clustered_snapshot(spark.createDataFrame([(D(2024, 1, 1), "fire", "severe", 1)], schema), f"{scratch}/s")
    write_clustered_snapshot(spark.createDataFrame([], schema), f"{scratch}/s")
    assert not [d for d in os.listdir(f"{scratch}/s".replace("file:", "")) if d.startswith("event_date=")]


def test_clustered_files_hold_ranges_and_share_a_hot_value(spark, scratch):
    """One date with one hot value: its rows lie in several files, and files meet in one value at most."""
    rows = spark.range(20_000).select(
        F.lit(D(2024, 1, 1)).alias("event_date"),
        F.when(F.col("id") % 10 < 8, "fire").otherwise("quake").alias("event_type"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 < 2, "low").otherwise("severe").alias("severity_level"),
        "id",
    )
    got = write_clustered_snapshot(rows, f"{scratch}/s", files=8)
    assert got.rows == 20_000 and got.folders == {"event_date=2024-01-01"}
    key = F.struct("event_type", "severity_level")
    stored = spark.read.parquet(f"{scratch}/s").withColumn("file", F.col("_metadata.file_name"))
    files = stored.groupBy("file").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n")).collect()
    assert len(files) == 8 and max(f.n for f in files) < 5_000
    hot = stored.where("event_type = 'fire' AND severity_level = 'low'")
    assert hot.select("file").distinct().count() >= 3

    def order(value):
        return tuple((x is not None, x or "") for x in value)

    files.sort(key=lambda f: (order(f.lo), order(f.hi)))
    assert all(order(b.lo) >= order(a.hi) for a, b in zip(files, files[1:], strict=False))
    assert stored.select("id").distinct().count() == 20_000
