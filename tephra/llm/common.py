"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.session import run_dir, shared_dir

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])

# Rows and bytes of one Arrow batch: a Python worker holds one batch of texts at a time.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def setup(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and let the Python workers import this package."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    shared_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return setup(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared checkpoint folder and read back: cuts the lineage.

    The files are on shared storage, so a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in have:
        name = "_" + name
    return name
