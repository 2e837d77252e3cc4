"""The registered queries: each is ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's ``events`` table (or what Spark derives
from it) in full; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra import oracle
from tephra.functions.numeric import double_text, round_half_up
from tephra.operators import marts, parse, serving, staging
from tephra.operators.dedup import dedup
from tephra.session import prepare
from tephra.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return testdata.load(spark, sf_dir, "events")


def _stg(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = _events(spark, sf_dir)
    return (
        staging.stg_fires(testdata.fires_table(ev)),
        staging.stg_quakes(testdata.quakes_table(ev)),
    )


def q_fires_parse(spark, sf_dir):
    return parse.parse_fires(testdata.fire_payloads(_events(spark, sf_dir)))


def q_fires_ids(spark, sf_dir):
    """The derived keys of every parsed detection: event id and grid cell."""
    fires = parse.parse_fires(testdata.fire_payloads(_events(spark, sf_dir)))
    return fires.select("event_id", "cluster_id", "satellite", "acq_date", "acq_time")


def shown(combined: DataFrame) -> DataFrame:
    """Events with their averages to six digits: the last digits depend on summation order."""
    return combined.withColumns({c: round_half_up(F.col(c), 6) for c in ("latitude", "longitude", "intensity_measure")})


def q_fires_dedup(spark, sf_dir):
    payloads = testdata.fire_payloads(_events(spark, sf_dir), resend=True)
    return dedup(parse.parse_fires(payloads), ["event_id"], keep="first")


def _grid(rounding: str) -> Query:
    def run(spark, sf_dir):
        fires = parse.parse_fires(testdata.fire_payloads(_events(spark, sf_dir)), rounding=rounding)
        return fires.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_fires"))

    return run


def _quakes(payload_kw: dict, dedup_keys: list[str] | None = None) -> Query:
    def run(spark, sf_dir):
        payloads = testdata.quake_payloads(_events(spark, sf_dir), **payload_kw)
        rows = parse.parse_quakes(payloads).drop("processed_at")
        if dedup_keys:
            rows = dedup(rows, dedup_keys, keep="first")
        return rows

    return run


def q_stg_fires(spark, sf_dir):
    return staging.reference_columns(_stg(spark, sf_dir)[0])


def q_stg_quakes(spark, sf_dir):
    return staging.reference_columns(_stg(spark, sf_dir)[1])


def q_fire_summary(spark, sf_dir):
    return marts.fire_summary(_stg(spark, sf_dir)[0])


def q_quake_summary(spark, sf_dir):
    return marts.quake_summary(_stg(spark, sf_dir)[1])


def q_fire_clusters(spark, sf_dir):
    return shown(marts.fire_clusters(_stg(spark, sf_dir)[0]))


def q_combined_events(spark, sf_dir):
    return shown(marts.combined_events(*_stg(spark, sf_dir)))


def q_map_events(spark, sf_dir):
    out = shown(serving.map_events(marts.combined_events(*_stg(spark, sf_dir))))
    short = F.transform(F.split("latlong", ","), lambda x: double_text(round_half_up(x.cast("double"), 6)))
    return out.withColumns(
        {"bubble_size": round_half_up(F.col("bubble_size"), 4), "latlong": F.array_join(short, ",")}
    )


def q_fire_metrics(spark, sf_dir):
    return serving.fire_metrics(marts.fire_summary(_stg(spark, sf_dir)[0], ordered=False))


def q_quake_metrics(spark, sf_dir):
    return serving.quake_metrics(marts.quake_summary(_stg(spark, sf_dir)[1], ordered=False))


def q_realtime_summary(spark, sf_dir):
    f, q = _stg(spark, sf_dir)
    card = serving.realtime_summary_from_staging(f, q, as_of=oracle.AS_OF)
    return card.withColumn("max_fire_intensity_24h", round_half_up(F.col("max_fire_intensity_24h"), 6))


def core_queries() -> dict[str, Query]:
    return {
        "fires_parse": q_fires_parse,
        "fires_ids": q_fires_ids,
        "fires_dedup": q_fires_dedup,
        "fires_grid_trunc": _grid("trunc"),
        "fires_grid_floor": _grid("floor"),
        "quakes_parse": _quakes({}),
        "quakes_valid": _quakes({"junk": True}),
        "quakes_dedup": _quakes({"resend": True}, ["event_id"]),
        "stg_fires": q_stg_fires,
        "stg_quakes": q_stg_quakes,
        "fire_summary": q_fire_summary,
        "quake_summary": q_quake_summary,
        "fire_clusters": q_fire_clusters,
        "combined_events": q_combined_events,
        "map_events": q_map_events,
        "fire_metrics": q_fire_metrics,
        "quake_metrics": q_quake_metrics,
        "realtime_summary": q_realtime_summary,
    }


def all_queries() -> dict[str, Query]:
    from tephra.plans.maintenance import maintenance_queries
    from tephra.plans.streams import stream_queries

    return {**core_queries(), **stream_queries(), **maintenance_queries()}
