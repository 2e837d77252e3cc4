"""The command line, end to end on landed files (same session as the tests)."""

from __future__ import annotations

from tephra.__main__ import main
from tephra.sinks.parquet import read_table
from tephra.sources import testdata
from tephra.sources.landed import land_messages

SF = "/root/testdata/sf0.001"


def test_ingest_rebuild_export_retention_compact(spark, scratch):
    ev = testdata.load(spark, SF, "events")
    split = "doc_hour < TIMESTAMP'2024-01-16 12:00:00'"
    fires, quakes = testdata.fire_payloads(ev, resend=True), testdata.quake_payloads(ev, resend=True)
    base, marts_dir, out = f"{scratch}/events", f"{scratch}/marts", f"{scratch}/export"
    ingest = ["ingest", "--base", base, "--fires-dir", f"{scratch}/land_f",
              "--quakes-dir", f"{scratch}/land_q", "--available-now", "--rejects"]
    # Two arrivals that split one day, so 2024-01-16 gets two batch folders.
    land_messages(fires.where(split), f"{scratch}/land_f")
    land_messages(quakes.where(split), f"{scratch}/land_q")
    assert main(ingest) == 0
    land_messages(fires.where(f"NOT ({split})"), f"{scratch}/land_f")
    land_messages(quakes.where(f"NOT ({split})"), f"{scratch}/land_q")
    assert main(ingest) == 0
    rejects = read_table(spark, f"{base}/_rejects/fires").select("reason").distinct().collect()
    assert [r.reason for r in rejects] == ["missing_coordinates"]
    assert read_table(spark, f"{base}/_reports/fires").count() >= 2
    n_fires = testdata.fx_fires(ev).count()
    assert read_table(spark, f"{base}/fires").count() == n_fires

    assert main(["rebuild", "--base", base, "--target", marts_dir, "--as-of", "2024-01-31 00:00:00"]) == 0
    assert spark.sql("SELECT alert_status FROM v_looker_realtime_summary").count() == 1
    stored = "default.mv_looker_fire_metrics"
    assert spark.newSession().table(stored).count() == spark.table("fire_summary").count()
    for name in ("mv_combined_events", "mv_looker_fire_metrics", "mv_looker_earthquake_metrics"):
        spark.sql(f"DROP TABLE default.{name}")
    spark.sql("DROP VIEW default.v_looker_realtime_summary")
    assert main(["export", "--base", base, "--target", out]) == 0
    assert read_table(spark, f"{out}/combined_events").count() > 0
    assert main(["retention", "--base", base, "--as-of", "2024-01-20 02:00:00", "--dry-run"]) == 0
    assert read_table(spark, f"{base}/fires").count() == n_fires

    assert main(["compact", "--base", base, "--before", "2024-01-31"]) == 0
    after = read_table(spark, f"{base}/fires", drop_batch_key=False)
    assert after.count() == n_fires
    keys = {r[0] for r in after.where("acq_date = DATE'2024-01-16'").select("batch_key").distinct().collect()}
    assert len(keys) == 1 and keys.pop().startswith("compacted-")
