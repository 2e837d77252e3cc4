"""End-to-end compositions: the hourly rebuild and the SQL relations.

``register_views`` exposes every relation under the name the dashboards
use, as Spark SQL temporary views over the stored event tables, so SQL
written against those names runs unchanged::

    register_views(spark, "/data/events")
    spark.sql("SELECT alert_status FROM v_looker_realtime_summary")

``rebuild`` is the full model run: the two summary tables and the
combined events are recomputed from staging and written. ``refresh_views``
is the hourly one: it rebuilds the dates whose source files changed
(:mod:`tephra.plans.refresh`), of the models and of the dashboard relations,
which are stored tables that other sessions find by name: the map layer
(partitioned by day, clustered by type and severity) and both metrics, and the
live card as a catalog view, which is evaluated when it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.operators import marts, parse, serving, staging
from tephra.operators.dedup import dedup
from tephra.plans import partials, refresh
from tephra.session import prepare
from tephra.sinks.parquet import read_table, write_clustered_snapshot
from tephra.sources import testdata

# Relation names of the original models and dashboards.
VIEW_NAMES = {
    "stg_fires": "stg_fires",
    "stg_earthquakes": "stg_earthquakes",
    "fire_summary": "fire_summary",
    "earthquake_summary": "earthquake_summary",
    "combined_events": "combined_events",
    "map": "mv_combined_events",
    "fire_metrics": "mv_looker_fire_metrics",
    "quake_metrics": "mv_looker_earthquake_metrics",
    "realtime": "v_looker_realtime_summary",
}


def fire_summary_from_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV messages (each sent twice) -> parsed fires -> deduplicated ->
    staged -> daily fire summary."""
    prepare(spark)
    events = testdata.load(spark, sf_dir, "events")
    payloads = testdata.fire_payloads(events, resend=True)
    fires = dedup(parse.parse_fires(payloads), ["event_id"], keep="first")
    return marts.fire_summary(staging.stg_fires(fires))


def relations(fires: DataFrame, quakes: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """Every relation of the model graph, lazily, from the two event tables."""
    stg_f = staging.stg_fires(fires)
    stg_q = staging.stg_quakes(quakes)
    fs = marts.fire_summary(stg_f, ordered=False)
    qs = marts.quake_summary(stg_q, ordered=False)
    combined = marts.combined_events(stg_f, stg_q)
    return {
        "stg_fires": staging.reference_columns(stg_f),
        "stg_earthquakes": staging.reference_columns(stg_q),
        "fire_summary": fs,
        "earthquake_summary": qs,
        "combined_events": combined,
        "map": serving.map_events(combined),
        "fire_metrics": serving.fire_metrics(fs),
        "quake_metrics": serving.quake_metrics(qs),
        "realtime": serving.realtime_summary_from_staging(stg_f, stg_q, as_of),
    }


def register_views(spark: SparkSession, base_path: str, as_of=None) -> dict[str, DataFrame]:
    """Temp views over ``<base>/fires`` and ``<base>/earthquakes``."""
    prepare(spark)
    rels = relations(
        read_table(spark, f"{base_path}/fires"),
        read_table(spark, f"{base_path}/earthquakes"),
        as_of,
    )
    for key, df in rels.items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    return rels


def rebuild(spark: SparkSession, base_path: str, target_root: str, as_of=None) -> dict[str, DataFrame]:
    """Full rebuild of the stored models, then views over the stored copies.

    Tables: ``fire_summary``, ``earthquake_summary`` (partitioned by date)
    and ``combined_events`` (partitioned by date, clustered by type and
    severity). The dashboard relations are views over those tables.
    """
    rels = register_views(spark, base_path, as_of)
    # Snapshot writes swap partitions at commit: a failed rebuild leaves the
    # previous tables readable.
    for name in ("fire_summary", "earthquake_summary"):
        write_clustered_snapshot(rels[name], f"{target_root}/{name}", "event_date", cluster_by=())
    write_clustered_snapshot(rels["combined_events"], f"{target_root}/combined_events")
    stored = stored_relations(spark, target_root, as_of)
    for key, df in stored.items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    return stored


def stored_relations(spark: SparkSession, target_root: str, as_of=None) -> dict[str, DataFrame]:
    """The dashboard relations over the stored models."""
    fs = read_table(spark, f"{target_root}/fire_summary")
    qs = read_table(spark, f"{target_root}/earthquake_summary")
    ce = read_table(spark, f"{target_root}/combined_events")
    return {
        "fire_summary": fs,
        "earthquake_summary": qs,
        "combined_events": ce,
        "map": serving.map_events(ce),
        "fire_metrics": serving.fire_metrics(fs),
        "quake_metrics": serving.quake_metrics(qs),
        "realtime": serving.realtime_summary(serving.map_events(ce), as_of),
    }


# Dashboard relations that are stored and named in the catalog; the others are evaluated when read.
STORED_VIEWS = ("map", "fire_metrics", "quake_metrics")
# Fixed value: the original metrics views refresh hourly.
REFRESH_MINUTES = 60
SOURCES = {"fires": "acq_date", "earthquakes": "event_date"}


def stored_models(
    spark: SparkSession, base_path: str, target_root: str, merge_batches: bool = False, full: bool = False
) -> list[refresh.Stored]:
    """The summaries and the combined events, from the stored event tables.

    With ``merge_batches`` a changed date's summaries and clusters are merged from partial
    aggregates (:mod:`tephra.plans.partials`): only new batches of the date are read.
    """

    def fires(dates):
        stored = read_table(spark, f"{base_path}/fires")
        return staging.stg_fires(stored.where(refresh.on_dates(F.col("acq_date"), dates)))

    def quakes(dates):
        stored = read_table(spark, f"{base_path}/earthquakes")
        return staging.stg_quakes(stored.where(refresh.on_dates(F.col("event_date"), dates)))

    def brought_up(partial):
        # Called by a build, so after the refresh has listed the sources: what it found is in the merge.
        partials.update(spark, base_path, target_root, partial, full)
        return partial

    def merged_combined(dates):
        clusters = partials.merged(spark, target_root, brought_up(partials.fire_clusters_partial()), dates)
        return clusters.select(*marts.COMBINED_COLUMNS).unionByName(marts.quake_events(quakes(dates))).distinct()

    if merge_batches:
        return [
            refresh.Stored(
                "fire_summary",
                ("fires",),
                lambda d: partials.merged(spark, target_root, brought_up(partials.fire_summary_partial()), d),
            ),
            refresh.Stored(
                "earthquake_summary",
                ("earthquakes",),
                lambda d: partials.merged(spark, target_root, brought_up(partials.quake_summary_partial()), d),
            ),
            refresh.Stored("combined_events", ("fires", "earthquakes"), merged_combined, ("event_type", "severity_level")),
        ]
    return [
        refresh.Stored("fire_summary", ("fires",), lambda d: marts.fire_summary(fires(d), ordered=False)),
        refresh.Stored("earthquake_summary", ("earthquakes",), lambda d: marts.quake_summary(quakes(d), ordered=False)),
        refresh.Stored(
            "combined_events",
            ("fires", "earthquakes"),
            lambda d: marts.combined_events(fires(d), quakes(d)),
            ("event_type", "severity_level"),
        ),
    ]


def stored_dashboards(spark: SparkSession, target_root: str) -> list[refresh.Stored]:
    """The stored dashboard relations, from the stored models."""

    def of(model, relation):
        def build(dates):
            stored = read_table(spark, f"{target_root}/{model}")
            return relation(stored.where(refresh.on_dates(F.col("event_date"), dates)))

        return build

    return [
        refresh.Stored(
            VIEW_NAMES["map"],
            ("fires", "earthquakes"),
            of("combined_events", serving.map_events),
            ("event_type", "severity_level"),
        ),
        refresh.Stored(VIEW_NAMES["fire_metrics"], ("fires",), of("fire_summary", serving.fire_metrics)),
        refresh.Stored(VIEW_NAMES["quake_metrics"], ("earthquakes",), of("earthquake_summary", serving.quake_metrics)),
    ]


def refresh_models(
    spark: SparkSession,
    base_path: str,
    target_root: str,
    full: bool = False,
    refresh_minutes: int = 0,
    dashboards: bool = True,
    merge_batches: bool = False,
) -> DataFrame:
    """Rebuild the changed dates of the stored models (and dashboard relations); the log of replaced dates.

    A metrics table refreshed less than ``refresh_minutes`` ago stays as it is. ``merge_batches``
    as in :func:`stored_models`; with ``full`` the partial aggregates are made anew, too.
    """
    prepare(spark)
    tables = stored_models(spark, base_path, target_root, merge_batches, full)
    if dashboards:
        tables += stored_dashboards(spark, target_root)
    hourly = {VIEW_NAMES[k]: refresh_minutes for k in ("fire_metrics", "quake_metrics")}
    sources = {name: (f"{base_path}/{name}", key) for name, key in SOURCES.items()}
    return refresh.refresh(spark, sources, tables, target_root, full, hourly)


def refresh_views(
    spark: SparkSession,
    base_path: str,
    target_root: str,
    as_of=None,
    schema: str = "default",
    refresh_minutes: int = 0,
    full: bool = False,
    merge_batches: bool = False,
) -> dict[str, str]:
    """Refresh the models and the stored dashboard relations, and name them in the catalog.

    Only changed dates are rebuilt, all with ``full``. A metrics table younger than
    ``refresh_minutes`` (``REFRESH_MINUTES`` in the hourly job) is left as it is. Returns
    the catalog names.
    """
    register_views(spark, base_path, as_of)
    refresh_models(spark, base_path, target_root, full, refresh_minutes, merge_batches=merge_batches)
    for key, df in stored_relations(spark, target_root, as_of).items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    names = {}
    for key in STORED_VIEWS:
        name = VIEW_NAMES[key]
        names[key] = f"{schema}.{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[key]} USING parquet LOCATION '{target_root}/{name}'")
        spark.sql(f"MSCK REPAIR TABLE {names[key]} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {names[key]}")
    names["realtime"] = f"{schema}.{VIEW_NAMES['realtime']}"
    spark.sql(f"CREATE OR REPLACE VIEW {names['realtime']} AS {serving.realtime_sql(names['map'], as_of)}")
    return names
