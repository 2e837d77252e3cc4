"""Summaries and fire clusters kept as mergeable partial aggregates per batch folder.

A group's count, sums and extremes merge, so a date's summary is the merge of the partial
rows of its batch folders, and a new batch costs the reading of that batch only: the live
day is not aggregated again at every refresh. Averages are sums over counts, taken when read.

Below ``<target>/_partials/<mart>`` a run of :func:`update` leaves

* ``run=<n>``: the partial rows of the batch folders it aggregated, by source date;
* ``_manifest/<n>``: for every batch folder of the source its digest (names and sizes of its
  files) and the run that holds its partial rows.

A reader follows the newest complete manifest, so it sees each batch once, also while an
update runs or after one stopped half-way (its run number is taken again). A replayed batch
has another digest, a compacted date other folders: both are aggregated anew and the old
partial rows are no longer listed. Runs that neither this nor the last manifest lists are
deleted. More than ``MAX_RUNS`` listed runs are copied together, from partial rows, not events.
One update at a time writes a target.

A folder that changes while it is read is left out of the manifest, so the next update
aggregates it again. The sums of a group are added in another order than in a full rebuild:
raw averages may differ in their last digits, as between any two runs on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.operators import marts, staging
from tephra.plans.refresh import complete_runs, file_digest
from tephra.sinks.parquet import BATCH_KEY, hadoop_path, must, write_partitioned

FOLDER = "_partials"
MANIFEST_SCHEMA = "day string, batch string, digest string, run bigint"
MAX_RUNS = 64


@dataclass(frozen=True)
class Partial:
    """A mart by its groups, the columns it averages and takes extremes of, and how it is shown."""

    name: str
    source: str
    date_col: str
    staged: Callable[..., DataFrame]
    groups: dict[str, Column]
    group_types: str
    averages: tuple[str, ...]
    shown: Callable[[], list[Column]]
    largest: tuple[str, ...] = ()
    smallest: tuple[str, ...] = ()

    def parts(self) -> list[Column]:
        out = [F.count(F.lit(1)).alias("n")]
        for c in self.averages:
            out += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}")]
        out += [F.max(c).alias(f"max_{c}") for c in self.largest]
        return out + [F.min(c).alias(f"min_{c}") for c in self.smallest]


    def schema(self) -> str:
        """Columns of the stored partial rows (declared: a run may have no row)."""
        out = [f"day string, run bigint, batch string, {self.group_types}, n bigint"]
        out += [f"n_{c} bigint, sum_{c} double" for c in self.averages]
        out += [f"max_{c} {'timestamp' if c == 'event_time' else 'double'}" for c in self.largest]
        return ", ".join(out + [f"min_{c} double" for c in self.smallest])


def _avg(c: str) -> Column:
    return F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}"))


def _max(c: str) -> Column:
    return F.max(f"max_{c}")


# Built when used: columns need a running session.
def fire_summary_partial() -> Partial:
    b, power = "bright_ti4", "fire_radioactive_power"
    return Partial(
        "fire_summary",
        "fires",
        "acq_date",
        staging.stg_fires,
        {"event_date": F.to_date("event_time"), "satellite": F.col("satellite"), "confidence": F.col("confidence")},
        "event_date date, satellite string, confidence string",
        (b, power),
        lambda: marts.fire_summary_columns(F.sum("n"), _avg(b), _max(b), _avg(power), _max(power)),
        largest=(b, power),
    )


def quake_summary_partial() -> Partial:
    m, d = "magnitude", "depth"
    return Partial(
        "earthquake_summary",
        "earthquakes",
        "event_date",
        staging.stg_quakes,
        {"event_date": F.to_date("event_time"), "hour": F.hour("event_time").cast("int")},
        "event_date date, hour int",
        (m, d),
        lambda: marts.quake_summary_columns(F.sum("n"), _avg(m), _max(m), F.min(f"min_{m}"), _avg(d), _max(d)),
        largest=(m, d),
        smallest=(m,),
    )


def fire_clusters_partial() -> Partial:
    return Partial(
        "fire_clusters",
        "fires",
        "acq_date",
        staging.stg_fires,
        {"event_date": F.to_date("event_time"), "cluster_id": F.col("cluster_id")},
        "event_date date, cluster_id string",
        ("latitude", "longitude", "bright_ti4"),
        lambda: marts.fire_cluster_columns(_avg("latitude"), _avg("longitude"), _avg("bright_ti4"), _max("event_time")),
        largest=("event_time",),
    )


def _text(df: DataFrame, name: str) -> Column:
    """A partition value as text; a missing one, or a table without the column, is empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def batch_digests(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """``day, batch, digest`` per batch folder of a stored table, from a listing (no file is opened)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    keys = (_text(files, date_col).alias("day"), _text(files, BATCH_KEY).alias("batch"))
    return files.groupBy(*keys).agg(file_digest().alias("digest"))


def _folder(target_root: str, partial: Partial) -> str:
    return f"{target_root.rstrip('/')}/{FOLDER}/{partial.name}"


def _run_folder(folder: str, run: int) -> str:
    return f"{folder}/run={run}"


def manifest(spark: SparkSession, target_root: str, partial: Partial) -> DataFrame | None:
    """``day, batch, digest, run`` of the newest complete update, or None."""
    folder = f"{_folder(target_root, partial)}/_manifest"
    found = complete_runs(spark, folder)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/{found[-1]}") if found else None


def _listed(spark: SparkSession, folder: str, partial: Partial, held: DataFrame) -> DataFrame:
    """The partial rows that a manifest lists."""
    runs = sorted(r.run for r in held.select("run").distinct().collect())  # at most MAX_RUNS and one
    if not runs:
        return spark.createDataFrame([], partial.schema())
    rows = spark.read.schema(partial.schema()).option("basePath", folder)
    rows = rows.parquet(*(_run_folder(folder, r) for r in runs)).withColumn("day", F.coalesce("day", F.lit("")))
    return rows.join(held.select("day", "batch", "run"), ["day", "batch", "run"], "left_semi")


def update(spark: SparkSession, base_path: str, target_root: str, partial: Partial, full: bool = False) -> int:
    """Aggregate the batch folders that are new or changed (all with ``full``); returns their number."""
    path, folder = f"{base_path}/{partial.source}", _folder(target_root, partial)
    found = complete_runs(spark, f"{folder}/_manifest")
    held = None if full else manifest(spark, target_root, partial)
    run = found[-1] + 1 if found else 0
    # Fixed now: the listing must not be newer than the rows read.
    now = batch_digests(spark, path, partial.date_col).checkpoint()
    key = ["day", "batch", "digest"]
    kept = None if held is None else held.join(now, key, "left_semi").checkpoint()
    fresh = now if kept is None else now.join(kept, key, "left_anti").checkpoint()
    # One value per new batch folder.
    names = None if kept is None else [r[0] for r in fresh.select(F.concat_ws("/", "day", "batch")).collect()]
    if names == [] and kept.count() == held.count():
        return 0
    if kept is not None and kept.select("run").distinct().count() >= MAX_RUNS:
        carried = _listed(spark, folder, partial, kept).drop("run")
        kept = kept.withColumn("run", F.lit(run).cast("bigint"))
    else:
        carried = None
    rows = _aggregated(spark, path, partial, names)
    if carried is not None:
        rows = rows.unionByName(carried)
    write_partitioned(rows, _run_folder(folder, run), "day", "overwrite")
    settled = fresh.join(batch_digests(spark, path, partial.date_col), key, "left_semi")
    settled = settled.withColumn("run", F.lit(run).cast("bigint"))
    listed = settled if kept is None else kept.unionByName(settled)
    listed.select("day", "batch", "digest", "run").coalesce(1).write.mode("overwrite").parquet(f"{folder}/_manifest/{run}")
    _drop_unlisted(spark, folder, found[-1:] + [run])
    return fresh.count()


def _aggregated(spark: SparkSession, path: str, partial: Partial, names: list[str] | None) -> DataFrame:
    """Partial rows of the batch folders ``day/batch`` in ``names`` (None: all)."""
    stored = spark.read.parquet(path)
    day, batch = _text(stored, partial.date_col), _text(stored, BATCH_KEY)
    if names is not None:
        # Partition values only: other folders are not opened.
        stored = stored.where(F.concat_ws("/", day, batch).isin(names))
    tagged = stored.withColumns({"source_day": day, "source_batch": batch})
    staged = partial.staged(tagged, carry=("source_day", "source_batch"))
    groups = [c.alias(name) for name, c in partial.groups.items()]
    keys = (F.col("source_day").alias("day"), F.col("source_batch").alias("batch"))
    return staged.groupBy(*keys, *groups).agg(*partial.parts())


def _drop_unlisted(spark: SparkSession, folder: str, manifests: list[int]) -> None:
    """Delete the runs that none of ``manifests`` lists, and the older manifests."""
    lists = spark.read.schema(MANIFEST_SCHEMA).parquet(*(f"{folder}/_manifest/{n}" for n in manifests))
    used = {f"run={r.run}" for r in lists.select("run").distinct().collect()}
    for root, keep, is_mine in (
        (folder, used, lambda n: n.startswith("run=")),
        (f"{folder}/_manifest", {str(n) for n in manifests}, str.isdigit),
    ):
        top, fs = hadoop_path(spark, root)
        for st in fs.listStatus(top):
            name = st.getPath().getName()
            if is_mine(name) and name not in keep:
                must(fs.delete(st.getPath(), True), f"delete {st.getPath()}")


def merged(spark: SparkSession, target_root: str, partial: Partial, dates: list | None = None) -> DataFrame:
    """The mart as the merge of its partial rows, of the source dates ``dates`` (None: all)."""
    folder, held = _folder(target_root, partial), manifest(spark, target_root, partial)
    if held is None:
        raise ValueError(f"{folder}: no partial aggregates yet; update them first")
    if dates is not None:
        held = held.where(F.col("day").isin(["" if d is None else str(d) for d in dates]))
    return _listed(spark, folder, partial, held).groupBy(*partial.groups).agg(*partial.shown())


def refresh(spark: SparkSession, base_path: str, target_root: str, full: bool = False) -> dict[str, int]:
    """Bring the partial aggregates of all three marts up to date; new batch folders per mart."""
    every = (fire_summary_partial(), quake_summary_partial(), fire_clusters_partial())
    return {p.name: update(spark, base_path, target_root, p, full) for p in every}


def fire_summary(spark: SparkSession, target_root: str, dates: list | None = None) -> DataFrame:
    return merged(spark, target_root, fire_summary_partial(), dates)


def quake_summary(spark: SparkSession, target_root: str, dates: list | None = None) -> DataFrame:
    return merged(spark, target_root, quake_summary_partial(), dates)


def fire_clusters(spark: SparkSession, target_root: str, dates: list | None = None) -> DataFrame:
    return merged(spark, target_root, fire_clusters_partial(), dates).select(*marts.COMBINED_COLUMNS)
