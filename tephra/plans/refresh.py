"""Refresh of stored models by date: only the dates whose source files changed are rebuilt.

A stored event table never changes a file in place: a batch, a compaction or a deletion
adds files or removes them. The names and sizes of a date's files are therefore a digest
of the date, and a listing finds the changed dates without reading any data. Per target
table the digests of its last refresh are kept below ``<target>/_refresh/<table>``.

A refresh lists the sources first and reads them afterwards, so a file that comes in
between is read now and found as changed by the next refresh; none is missed. The digests
are stored after the table is written: a run that stops in between is repeated for the
same dates, which replaces them once more. One refresh at a time writes a target.

The digests know the data, not the rules: after a change of the models' code use ``full``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.sinks.parquet import hadoop_path, must, partition_folder, path_exists, write_clustered_snapshot

STATE = "_refresh"
STATE_SCHEMA = "day date, digest string, refreshed_at timestamp"
Dates = list[dt.date | None] | None
LOG_SCHEMA = "table_name string, event_date date, action string"


@dataclass(frozen=True)
class Stored:
    """A stored relation: the event tables it comes from, and its rows of some dates (``None``: all)."""

    name: str
    sources: tuple[str, ...]
    build: Callable[[Dates], DataFrame]
    cluster_by: tuple[str, ...] = ()


def on_dates(day: Column, dates: Dates) -> Column:
    """Whether a row belongs to ``dates``; a missing date (None) is one of its own."""
    if dates is None:
        return F.lit(True)
    found = day.isin([d for d in dates if d is not None])
    return F.coalesce(found, F.lit(False)) | day.isNull() if None in dates else found


def file_digest() -> Column:
    """Aggregate of a listing (``path``, ``length``): changes with any file's name or size."""
    mark = F.xxhash64("path", "length")
    parts = (F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)")))
    return F.concat_ws(":", *(p.cast("string") for p in parts))


def source_digests(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """``day, digest`` per date of a stored table, from a listing (no file is opened)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(F.col(date_col).cast("date").alias("day")).agg(file_digest().alias("digest"))


def _joined(digests: Iterable[DataFrame]) -> DataFrame:
    """One digest per date of several sources."""
    tagged = [d.select("day", F.concat(F.lit(f"{i}="), F.col("digest")).alias("digest")) for i, d in enumerate(digests)]
    every = reduce(DataFrame.unionByName, tagged)
    # One part per source.
    return every.groupBy("day").agg(F.array_join(F.sort_array(F.collect_list("digest")), ";").alias("digest"))


def complete_runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete states, oldest first."""
    if not path_exists(spark, folder):
        return []
    root, fs = hadoop_path(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{folder}/{n}/_SUCCESS"))


def read_state(spark: SparkSession, target_root: str, table: str) -> DataFrame | None:
    """``day, digest, refreshed_at`` of a table's last refresh, or None."""
    folder = f"{target_root}/{STATE}/{table}"
    runs = complete_runs(spark, folder)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{folder}/{runs[-1]}") if runs else None


def _store_state(spark: SparkSession, target_root: str, table: str, digests: DataFrame) -> None:
    folder = f"{target_root}/{STATE}/{table}"
    old = complete_runs(spark, folder)
    number = old[-1] + 1 if old else 0
    state = digests.select("day", "digest", F.current_timestamp().alias("refreshed_at"))
    # One row per date. An incomplete folder of this number is from a run that stopped.
    state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{number}")
    for n in old:
        gone, fs = hadoop_path(spark, f"{folder}/{n}")
        must(fs.delete(gone, True) or not fs.exists(gone), f"delete {gone}")


def changed_dates(now: DataFrame, before: DataFrame) -> list[dt.date | None]:
    """Dates that are new, gone or have other files (a union and a group-by; one value per date)."""
    none = F.lit(None).cast("string")
    both = now.select("day", F.col("digest").alias("now"), none.alias("before")).unionByName(
        before.select("day", none.alias("now"), F.col("digest").alias("before"))
    )
    merged = both.groupBy("day").agg(F.max("now").alias("now"), F.max("before").alias("before"))
    return [r.day for r in merged.where(~F.col("now").eqNullSafe(F.col("before"))).orderBy("day").collect()]


def _young(state: DataFrame, minutes: int) -> bool:
    """Whether the last refresh is younger than ``minutes``; both times are this cluster's own clock.

    A time ahead of the clock says nothing and counts as old.
    """
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.max("refreshed_at"))
    seconds = state.agg(age.alias("age")).first()["age"]
    return seconds is not None and 0 <= seconds < 60 * minutes


def refresh(
    spark: SparkSession,
    sources: dict[str, tuple[str, str]],
    tables: Iterable[Stored],
    target_root: str,
    full: bool = False,
    minutes: dict[str, int] | None = None,
) -> DataFrame:
    """Bring ``tables`` up to date, in order; returns ``table_name, event_date, action`` (written or removed).

    ``sources`` maps a name to ``(path, date column)``. ``full``, or a target without a stored
    state, rebuilds every date. A table whose last refresh is younger than its ``minutes`` stays
    as it is; its own state then finds all that changed meanwhile at its next refresh.
    """
    digests = {}
    for name, (path, date_col) in sources.items():
        # Fixed now: later listings must not be newer than the rows read.
        digests[name] = source_digests(spark, path, date_col).checkpoint()
    log = []
    for table in tables:
        state = read_state(spark, target_root, table.name)
        if state is not None and not full and _young(state, (minutes or {}).get(table.name, 0)):
            continue
        now = _joined(digests[s] for s in table.sources)
        dates = None if full or state is None else changed_dates(now, state)
        if dates != []:
            rows = table.build(dates).where(on_dates(F.col("event_date"), dates))
            path = f"{target_root}/{table.name}"
            kept = write_clustered_snapshot(rows, path, "event_date", table.cluster_by, only_dates=dates).folders
            days = dates if dates is not None else [r.day for r in now.select("day").collect()]
            log += [
                (table.name, day, "written" if partition_folder("event_date", day) in kept else "removed") for day in days
            ]
        _store_state(spark, target_root, table.name, now)
    return spark.createDataFrame(log, LOG_SCHEMA)
