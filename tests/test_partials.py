"""Marts merged from partial aggregates of the batch folders."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tephra.functions.numeric import round_half_up
from tephra.operators import marts, staging
from tephra.plans import partials, pipeline
from tephra.sinks.parquet import BATCH_KEY, compact_date, hadoop_path, path_exists, read_table
from tephra.sources import testdata

DAY = "2024-01-05"


def _fires(spark):
    return testdata.fires_table(testdata.load(spark, SF_SMALL, "events")).where("acq_date <= DATE'2024-01-08'")


def _put(rows, base, batch, table="fires", key="acq_date"):
    rows = rows.withColumn(BATCH_KEY, F.lit(batch)).coalesce(1)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key, BATCH_KEY).parquet(f"{base}/{table}")


def _update(spark, base, full=False):
    return partials.update(spark, base, f"{base}/marts", partials.fire_summary_partial(), full)


def _same(spark, base):
    """The merged summary equals the rebuilt one."""
    want = marts.fire_summary(staging.stg_fires(read_table(spark, f"{base}/fires")), ordered=False)
    got = partials.fire_summary(spark, f"{base}/marts")
    assert got.columns == want.columns
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()


def test_only_new_batches_are_aggregated(spark, scratch):
    fires = _fires(spark)
    _put(fires, scratch, "b-0")
    assert _update(spark, scratch) == 8 and _same(spark, scratch)
    assert _update(spark, scratch) == 0

    # A late batch of two old dates: no file of the first batch is opened.
    late = fires.where(f"acq_date IN (DATE'{DAY}', DATE'2024-01-02')").withColumn("satellite", F.lit("N99"))
    _put(late, scratch, "b-1")
    names = [f"{DAY}/b-1", "2024-01-02/b-1"]
    one = partials.fire_summary_partial()
    read = partials._aggregated(spark, f"{scratch}/fires", one, names)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan
    assert not _same(spark, scratch)
    assert _update(spark, scratch) == 2 and _same(spark, scratch)
    held = partials.manifest(spark, f"{scratch}/marts", one)
    assert {(r.run, r["count"]) for r in held.groupBy("run").count().collect()} == {(0, 8), (1, 2)}

    # A replay with other rows, and a compaction of the date: aggregated anew, counted once.
    _put(late.limit(3), scratch, "b-1")
    assert _update(spark, scratch) >= 1 and _same(spark, scratch)
    compact_date(spark, f"{scratch}/fires", "acq_date", DAY)
    assert _update(spark, scratch) == 1 and _same(spark, scratch)

    # A date that the retention dropped goes, without anything to aggregate.
    gone, fs = hadoop_path(spark, f"{scratch}/fires/acq_date={DAY}")
    assert fs.delete(gone, True)
    assert _update(spark, scratch) == 0 and _same(spark, scratch)
    assert partials.fire_summary(spark, f"{scratch}/marts").where(f"event_date = DATE'{DAY}'").isEmpty()
    only = partials.fire_summary(spark, f"{scratch}/marts", ["2024-01-02"])
    assert {str(r[0]) for r in only.select("event_date").distinct().collect()} == {"2024-01-02"}
    assert partials.fire_summary(spark, f"{scratch}/marts", []).isEmpty()
    # The first batch's seven dates that are left, and the late one's folder.
    assert _update(spark, scratch, full=True) == 8 and _same(spark, scratch)


def test_an_update_that_stops_is_repeated(spark, scratch, monkeypatch):
    fires = _fires(spark)
    _put(fires, scratch, "b-0")
    _update(spark, scratch)
    before = partials.fire_summary(spark, f"{scratch}/marts").agg(F.sum("fire_count")).first()[0]
    _put(fires.withColumn("satellite", F.lit("N99")), scratch, "b-1")

    # Stopped after the partial rows, before the manifest: readers still follow the old one.
    listing = partials.batch_digests
    calls = []

    def second_fails(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stopped")
        return listing(*args)

    with monkeypatch.context() as m:
        m.setattr(partials, "batch_digests", second_fails)
        with pytest.raises(OSError, match="stopped"):
            _update(spark, scratch)
    assert partials.fire_summary(spark, f"{scratch}/marts").agg(F.sum("fire_count")).first()[0] == before
    assert _update(spark, scratch) == 8 and _same(spark, scratch)


def test_a_folder_that_changes_meanwhile_is_aggregated_again(spark, scratch, monkeypatch):
    fires = _fires(spark).where(f"acq_date = DATE'{DAY}'")
    _put(fires, scratch, "b-0")
    write = partials.write_partitioned

    def replayed(*args, **kw):
        write(*args, **kw)
        _put(fires.limit(5), scratch, "b-0")

    with monkeypatch.context() as m:
        m.setattr(partials, "write_partitioned", replayed)
        _update(spark, scratch)
    assert partials.manifest(spark, f"{scratch}/marts", partials.fire_summary_partial()).isEmpty()
    assert _update(spark, scratch) == 1 and _same(spark, scratch)


def test_many_runs_are_copied_together_and_old_ones_go(spark, scratch, monkeypatch):
    monkeypatch.setattr(partials, "MAX_RUNS", 2)
    fires = _fires(spark).where(f"acq_date = DATE'{DAY}'")
    for n in range(4):
        _put(fires.withColumn("satellite", F.lit(f"N{n}")), scratch, f"b-{n}")
        assert _update(spark, scratch) == 1 and _same(spark, scratch)
    held = partials.manifest(spark, f"{scratch}/marts", partials.fire_summary_partial())
    assert {(r.run, r.batch) for r in held.collect()} == {(2, "b-0"), (2, "b-1"), (2, "b-2"), (3, "b-3")}
    folder = f"{scratch}/marts/{partials.FOLDER}/fire_summary"
    assert not path_exists(spark, f"{folder}/run=0") and not path_exists(spark, f"{folder}/_manifest/1")


def test_batches_without_a_usable_row_and_dates_that_are_missing(spark, scratch):
    fires = _fires(spark).where(f"acq_date = DATE'{DAY}'")
    nowhere = fires.withColumn("latitude", F.lit(None).cast("double"))
    _put(nowhere, scratch, "b-0")
    assert _update(spark, scratch) == 1
    assert partials.fire_summary(spark, f"{scratch}/marts").isEmpty()
    with pytest.raises(ValueError, match="update them first"):
        partials.quake_summary(spark, f"{scratch}/marts")
    undated = fires.withColumns(
        {"acq_date": F.lit(None).cast("date"), "event_timestamp": F.lit(None).cast("timestamp")}
    )
    _put(undated.unionByName(fires.withColumn("frp", F.lit(None).cast("double"))), scratch, "b-1")
    assert _update(spark, scratch) == 2
    stg = staging.stg_fires(read_table(spark, f"{scratch}/fires"))
    want = {tuple(r) for r in marts.fire_summary(stg, ordered=False).collect()}
    assert {tuple(r) for r in partials.fire_summary(spark, f"{scratch}/marts").collect()} == want


def test_refresh_by_merging_equals_a_rebuild(spark, scratch):
    ev = testdata.load(spark, SF_SMALL, "events").where("ts < TIMESTAMP'2024-01-06'")
    target = f"{scratch}/marts"
    for n, part in enumerate(("hour(ts) >= 6", "hour(ts) < 6 AND day(ts) <= 2")):
        _put(testdata.fires_table(ev.where(part)), scratch, f"b-{n}")
        _put(testdata.quakes_table(ev.where(part)), scratch, f"b-{n}", "earthquakes", "event_date")
        log = pipeline.refresh_models(spark, scratch, target, dashboards=False, merge_batches=True)
    assert {str(r.event_date) for r in log.collect()} == {"2024-01-01", "2024-01-02"}
    f = staging.stg_fires(read_table(spark, f"{scratch}/fires"))
    q = staging.stg_quakes(read_table(spark, f"{scratch}/earthquakes"))
    for name, want in marts.build_marts(f, q).items():
        got = read_table(spark, f"{target}/{name}").select(*want.columns)
        # Averages of clusters depend in their last digits on the order of summation.
        got, want = (
            x.select(*(round_half_up(F.col(c), 6).alias(c) if t == "double" else F.col(c) for c, t in x.dtypes))
            for x in (got, want)
        )
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()
