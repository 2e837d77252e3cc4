"""Landed-file source: raw feed messages dropped as files into a folder.

Stands in for the HTTP -> broker hop. Messages are stored one per row in
Parquet (column ``value``) or one per file as text (``wholetext``), and
read either as a batch or as a file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE_SCHEMA = "value string"


def land_messages(payloads: DataFrame, path: str, files: int | None = None) -> None:
    """Append one batch of messages (column ``value``) as Parquet files."""
    out = payloads.select("value")
    if files:
        out = out.repartition(files)
    out.write.mode("append").parquet(path)


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(VALUE_SCHEMA).parquet(path)
    if fmt == "text":
        # Passed to text() itself: its own default would override an option().
        return spark.read.text(path, wholetext=True)
    raise ValueError(f"unknown format {fmt!r}")


def stream_messages(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of messages; ``max_files_per_trigger`` bounds a batch."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "parquet":
        df = reader.schema(VALUE_SCHEMA).parquet(path)
    elif fmt == "text":
        df = reader.text(path, wholetext=True)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return df.where(F.col("value").isNotNull())
