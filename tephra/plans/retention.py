"""Partition retention for date-partitioned Parquet datasets.

``retention_plan`` lists the first-level folders of each dataset (one row per
partition; empty ones too) and decides per folder:

* ``delete`` - ``<key>=<date>`` with the date before ``as_of - (days + buffer)``
  (the cutoff keeps the time of day of ``as_of``, strict ``<``);
* ``keep``   - a newer date;
* ``error``  - the value is not a ``yyyy-MM-dd`` date (e.g. the NULL partition);
* ``skip``   - a directory without ``=`` or with another key (counted as scanned).

``apply_retention`` removes the ``delete`` partitions (Hadoop FileSystem,
so any cluster file system works; or ``ALTER TABLE .. DROP PARTITION`` for
a catalog table), each on its own: one that fails is recorded and the others
go on. ``retention_report`` summarises plan and outcome per dataset.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.sinks.parquet import hadoop_path, must, path_exists

# The original schedule keeps 7 days plus a 1-day buffer.
RETENTION_DAYS = 7
BUFFER_DAYS = 1


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp")


INVENTORY = "partition string, n_files bigint, bytes bigint"


def partition_inventory(spark: SparkSession, dataset_path: str) -> DataFrame:
    """One row per first-level folder: name, file count, bytes.

    Folder names and totals come from the file system's own summary; the files of the
    table are never listed in the driver.
    """
    root, fs = hadoop_path(spark, dataset_path)
    rows = []
    for st in fs.listStatus(root):
        if st.isDirectory():
            total = fs.getContentSummary(st.getPath())
            rows.append((st.getPath().getName(), total.getFileCount(), total.getLength()))
    return spark.createDataFrame(rows, INVENTORY)


def plan_partitions(
    inventory: DataFrame,
    dataset: str,
    partition_key: str,
    as_of=None,
    retention_days: int = RETENTION_DAYS,
    buffer_days: int = BUFFER_DAYS,
) -> DataFrame:
    cutoff = _ts(as_of) - F.make_interval(days=F.lit(retention_days + buffer_days))
    name = F.col("partition")
    has_eq = F.instr(name, "=") > 0
    key = F.substring_index(name, "=", 1)
    value = F.when(has_eq, F.expr("substring(partition, instr(partition, '=') + 1)"))
    day = F.try_to_date(value, "yyyy-MM-dd")
    action = (
        F.when(~has_eq | (key != F.lit(partition_key)), F.lit("skip"))
        .when(day.isNull(), F.lit("error"))
        .when(day.cast("timestamp") < cutoff, F.lit("delete"))
        .otherwise(F.lit("keep"))
    )
    return inventory.select(
        F.lit(dataset).alias("dataset"),
        "partition",
        day.alias("partition_date"),
        action.alias("action"),
        "n_files",
        "bytes",
        F.round(F.col("bytes") / F.lit(1024 * 1024), 2).alias("size_mb"),
        F.to_date(cutoff).alias("cutoff_date"),
    )


def retention_plan(
    spark: SparkSession,
    base_path: str,
    datasets: dict[str, str],
    as_of=None,
    retention_days: int = RETENTION_DAYS,
    buffer_days: int = BUFFER_DAYS,
) -> DataFrame:
    """Plan for several datasets ``{name: partition_key}`` under ``base_path``."""
    plans = []
    for name, key in datasets.items():
        path = f"{base_path.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            # A missing dataset is reported as one error row, not raised.
            inv = spark.createDataFrame([], INVENTORY)
            missing = plan_partitions(inv, name, key, as_of, retention_days, buffer_days)
            missing = spark.createDataFrame(
                [(name, None, None, "error", 0, 0, 0.0, None)], missing.schema
            )
            plans.append(missing)
            continue
        inv = partition_inventory(spark, path)
        plans.append(plan_partitions(inv, name, key, as_of, retention_days, buffer_days))
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    # Partitions in name order, as the original job visited them (one row each).
    return out.orderBy("dataset", "partition")


def with_row_counts(plan: DataFrame, spark: SparkSession, base_path: str, datasets: dict[str, str]) -> DataFrame:
    """Add ``n_rows`` per partition (Parquet footers only; no column is read).

    Plan rows and counts are merged by a union and a group-by on the
    partition (one small shuffle) rather than by a join.
    """
    # Only folders the plan recognised as dates are read (one name per date
    # comes to the driver): stray folders would break partition discovery.
    dated = plan.where(F.col("action").isin("keep", "delete")).select("dataset", "partition").collect()
    counts = None
    for name, key in datasets.items():
        root = f"{base_path.rstrip('/')}/{name}"
        paths = [f"{root}/{r.partition}" for r in dated if r.dataset == name]
        if not paths:
            continue
        df = spark.read.option("basePath", root).parquet(*paths)
        c = (
            df.groupBy(F.concat(F.lit(f"{key}="), F.col(key).cast("string")).alias("partition"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("dataset"), "partition", "n_rows")
        )
        counts = c if counts is None else counts.unionByName(c)
    if counts is None:
        return plan.withColumn("n_rows", F.lit(None).cast("long"))
    return merge_on(plan, counts, ["dataset", "partition"])


def merge_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows with the right's extra columns added, keys unique on both
    sides: a union plus ``first(ignorenulls)`` per key instead of a join."""
    extra = [c for c in right.columns if c not in keys]
    own = [c for c in left.columns if c not in keys]
    l = left.select(*keys, *own, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra], F.lit(True).alias("_left"))
    r = right.select(*keys, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in own], *extra, F.lit(False).alias("_left"))
    merged = l.unionByName(r).groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in own + extra],
        F.max("_left").alias("_left"),
    )
    return merged.where("_left").select(*left.columns, *extra)


OUTCOME = "dataset string, partition string, done boolean, error string"


def apply_retention(
    spark: SparkSession,
    plan: DataFrame,
    base_path: str,
    dry_run: bool = False,
    tables: dict[str, str] | None = None,
) -> list[dict]:
    """Delete the planned partitions; returns one record per planned one, ``done`` or with its ``error``.

    Only the list of partitions to drop (one small record per date) comes
    to the driver. ``tables`` maps a dataset to a catalog table name, in
    which case the partition is dropped through the catalog. A partition
    that cannot be dropped does not stop the others.
    """
    todo = plan.where(F.col("action") == "delete").select(
        "dataset", "partition", "partition_date", "bytes"
    ).collect()
    outcome = []
    for r in todo:
        error = None
        try:
            if not dry_run:
                _drop(spark, r, base_path, tables or {})
        except Exception as e:  # noqa: BLE001 - recorded, the next partition goes on
            error = f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"
        outcome.append({**r.asDict(), "done": error is None, "error": error})
    return outcome


def _drop(spark: SparkSession, r, base_path: str, tables: dict[str, str]) -> None:
    if r.dataset in tables:
        key, value = r.partition.split("=", 1)
        spark.sql(f"ALTER TABLE {tables[r.dataset]} DROP IF EXISTS PARTITION ({key} = '{value}')")
        return
    path, fs = hadoop_path(spark, f"{base_path.rstrip('/')}/{r.dataset}/{r.partition}")
    must(fs.delete(path, True) or not fs.exists(path), f"delete {path}")


def retention_report(plan: DataFrame, outcome: list[dict] | None = None) -> DataFrame:
    """Per dataset: partitions scanned and deleted (with their names), bytes freed, cutoff, errors (with texts).

    Without an ``outcome`` every planned deletion counts as done.
    """
    spark = plan.sparkSession
    planned = F.col("action") == "delete"
    if outcome is None:
        rows = plan.withColumns({"done": planned, "error": F.lit(None).cast("string")})
    else:
        done = spark.createDataFrame(
            [(o["dataset"], o["partition"], o["done"], o["error"]) for o in outcome], OUTCOME
        )
        rows = merge_on(plan, done, ["dataset", "partition"])
    failed = (F.col("action") == "error") | F.col("error").isNotNull()
    text = F.concat_ws(": ", F.coalesce("partition", "dataset"), F.coalesce("error", F.lit("not a dated partition")))
    deleted = planned & F.coalesce("done", F.lit(False))
    return rows.groupBy("dataset").agg(
        F.count("partition").alias("partitions_scanned"),
        F.count_if(deleted).alias("partitions_deleted"),
        F.coalesce(F.sum(F.when(deleted, F.col("bytes"))), F.lit(0)).alias("bytes_freed"),
        F.max("cutoff_date").alias("cutoff_date"),
        F.count_if(failed).alias("errors"),
        # One name per date: bounded by the dataset's partitions.
        F.sort_array(F.collect_list(F.when(deleted, F.col("partition")))).alias("deleted"),
        F.sort_array(F.collect_list(F.when(failed, text))).alias("error_texts"),
    )


def retention_status(report: DataFrame) -> DataFrame:
    """Totals over all datasets and the job status (1 when any error)."""
    return report.agg(
        F.sum("partitions_scanned").alias("partitions_scanned"),
        F.sum("partitions_deleted").alias("partitions_deleted"),
        F.sum("bytes_freed").alias("bytes_freed"),
        F.sum("errors").alias("errors"),
        F.when(F.sum("errors") > 0, F.lit(1)).otherwise(F.lit(0)).alias("status"),
    )


def run_retention(
    spark: SparkSession,
    base_path: str,
    datasets: dict[str, str],
    as_of=None,
    retention_days: int = RETENTION_DAYS,
    buffer_days: int = BUFFER_DAYS,
    dry_run: bool = False,
    log_path: str | None = None,
) -> DataFrame:
    """The daily job: plan, delete, report; the report is appended to
    ``log_path`` (default ``<base>/_retention_log``) with the run time.

    The plan is checkpointed before anything is deleted, so the report
    describes what was removed rather than what is left.
    """
    plan = retention_plan(spark, base_path, datasets, as_of, retention_days, buffer_days).checkpoint()
    outcome = apply_retention(spark, plan, base_path, dry_run=dry_run)
    report = retention_report(plan, outcome).withColumn("dry_run", F.lit(dry_run)).withColumn(
        "run_at", _ts(as_of)
    )
    report.write.mode("append").parquet(log_path or f"{base_path.rstrip('/')}/_retention_log")
    return report
