"""The model graph as SQL views and the hourly rebuild."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tephra.operators import marts, staging
from tephra.plans import pipeline, refresh, retention
from tephra.sinks.parquet import hadoop_path, read_table, write_partitioned
from tephra.sources import testdata

SF = "/root/testdata/sf0.001"


def _stored(spark, base):
    ev = testdata.load(spark, SF, "events")
    write_partitioned(testdata.fires_table(ev), f"{base}/fires", "acq_date")
    write_partitioned(testdata.quakes_table(ev), f"{base}/earthquakes", "event_date")
    return ev


def test_views_answer_sql_and_rebuild_matches(spark, scratch):
    ev = _stored(spark, scratch)
    pipeline.register_views(spark, scratch, as_of="2024-01-31 00:00:00")
    n_fires = testdata.fx_fires(ev).where("latitude IS NOT NULL").count()  # staging needs coordinates
    assert spark.sql("SELECT SUM(fire_count) FROM fire_summary").first()[0] == n_fires
    live = spark.sql("SELECT * FROM v_looker_realtime_summary").first().asDict()
    n_map = spark.sql("SELECT COUNT(*) FROM mv_combined_events").first()[0]
    assert n_map == spark.sql("SELECT COUNT(*) FROM combined_events").first()[0]

    pipeline.rebuild(spark, scratch, f"{scratch}/marts", as_of="2024-01-31 00:00:00")
    stored = spark.sql("SELECT * FROM v_looker_realtime_summary").first().asDict()
    assert stored == live
    assert spark.sql("SELECT SUM(fire_count) FROM fire_summary").first()[0] == n_fires
    assert spark.sql("SELECT COUNT(*) FROM mv_looker_earthquake_metrics").first()[0] > 0


def test_run_retention_logs(spark, scratch):
    _stored(spark, scratch)
    rep = retention.run_retention(
        spark, scratch, {"fires": "acq_date", "earthquakes": "event_date"}, as_of="2024-01-20 02:00:00"
    )
    got = {r.dataset: (r.partitions_scanned, r.partitions_deleted) for r in rep.collect()}
    assert got == {"fires": (30, 12), "earthquakes": (30, 12)}
    log = spark.read.parquet(f"{scratch}/_retention_log").collect()
    assert len(log) == 2 and all(not r.dry_run for r in log)
    assert spark.read.parquet(f"{scratch}/fires").select("acq_date").distinct().count() == 18


MODELS = ("fire_summary", "earthquake_summary", "combined_events", "mv_combined_events", "mv_looker_fire_metrics")


def _files(spark, root, table):
    stored = read_table(spark, f"{root}/{table}").select("event_date", F.col("_metadata.file_name").alias("file"))
    found = {}
    for day, file in stored.distinct().collect():
        found.setdefault(str(day), set()).add(file)
    return found


def _replaced(before, after):
    return {d for d in before | after if before.get(d) != after.get(d)}


def test_refresh_rebuilds_only_changed_dates(spark, scratch, monkeypatch):
    ev = _stored(spark, scratch)
    target = f"{scratch}/marts"
    pipeline.refresh_models(spark, scratch, target)
    before = {t: _files(spark, target, t) for t in MODELS}

    # Nothing changed: nothing is written.
    assert pipeline.refresh_models(spark, scratch, target).count() == 0
    assert {t: _files(spark, target, t) for t in MODELS} == before

    # Late fires of one day, and a day of earthquakes dropped by the retention.
    fires = testdata.fires_table(ev)
    late = fires.where("acq_date = DATE'2024-01-05'").withColumn("satellite", F.lit("N99"))
    write_partitioned(late, f"{scratch}/fires", "acq_date")
    gone, fs = hadoop_path(spark, f"{scratch}/earthquakes/event_date=2024-01-07")
    assert fs.delete(gone, True)

    # A run that stops before its state is stored is repeated.
    with monkeypatch.context() as m:
        m.setattr(refresh, "_store_state", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            pipeline.refresh_models(spark, scratch, target)
    pipeline.refresh_models(spark, scratch, target)
    after = {t: _files(spark, target, t) for t in MODELS}
    fire_day, quake_day = "2024-01-05", "2024-01-07"
    assert _replaced(before["fire_summary"], after["fire_summary"]) == {fire_day}
    assert _replaced(before["mv_looker_fire_metrics"], after["mv_looker_fire_metrics"]) == {fire_day}
    assert _replaced(before["earthquake_summary"], after["earthquake_summary"]) == {quake_day}
    assert quake_day not in after["earthquake_summary"]
    for t in ("combined_events", "mv_combined_events"):
        assert _replaced(before[t], after[t]) == {fire_day, quake_day}

    # Equal to a full rebuild.
    f = staging.stg_fires(read_table(spark, f"{scratch}/fires"))
    q = staging.stg_quakes(read_table(spark, f"{scratch}/earthquakes"))
    whole = marts.build_marts(f, q)
    for name in ("fire_summary", "earthquake_summary"):
        stored = read_table(spark, f"{target}/{name}").select(*whole[name].columns)
        assert stored.exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(stored).isEmpty()
    # Averages of clusters depend in their last digits on the order of summation.
    key = ["event_type", "event_time", "event_date", "severity_level"]
    stored = read_table(spark, f"{target}/combined_events").select(*key)
    assert stored.exceptAll(whole["combined_events"].select(*key)).isEmpty()
    assert stored.count() == whole["combined_events"].count()

    # ``full`` replaces every date; a young metrics table waits, and misses nothing later.
    write_partitioned(late.withColumn("satellite", F.lit("N98")), f"{scratch}/fires", "acq_date")
    log = pipeline.refresh_models(spark, scratch, target, refresh_minutes=60)
    assert {r.table_name for r in log.collect()} == {"fire_summary", "combined_events", "mv_combined_events"}
    log = pipeline.refresh_models(spark, scratch, target)
    assert {(r.table_name, str(r.event_date)) for r in log.collect()} == {("mv_looker_fire_metrics", fire_day)}
    log = pipeline.refresh_models(spark, scratch, target, full=True)
    assert log.where("table_name = 'fire_summary'").count() == len(after["fire_summary"])


def test_refresh_with_a_missing_date(spark, scratch):
    """Rows without a date are a partition of their own, refreshed like any other."""
    day = F.to_date(F.lit("2024-01-01"))

    def put(tag):
        rows = spark.createDataFrame([(tag, True), (tag, False)], "tag string, dated boolean")
        rows = rows.select("tag", F.when(F.col("dated"), day).alias("event_date"))
        write_partitioned(rows, f"{scratch}/in", "event_date")

    def build(dates):
        stored = read_table(spark, f"{scratch}/in").where(refresh.on_dates(F.col("event_date"), dates))
        return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))

    table = refresh.Stored("counts", ("in",), build)

    def run():
        return refresh.refresh(spark, {"in": (f"{scratch}/in", "event_date")}, [table], scratch).count()

    put("a")
    assert run() == 2
    put("b")
    assert run() == 2
    assert run() == 0
    got = {(str(r.event_date), r.n) for r in read_table(spark, f"{scratch}/counts").collect()}
    assert got == {("None", 2), ("2024-01-01", 2)}
