"""Corpus pipeline: quality rules, quality classifier, near-duplicates, secrets, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns
of ``documents``; each result is written as Parquet and read again as the next stage's docs.

1. ``quality_rules``: documents that the compression-band rules reject go.
2. ``quality_classifier``: documents with a score below the threshold go. The model is
   fitted on the labelled rows of ``documents``, held-out fold excluded.
3. ``near_duplicates``: of each group of near-duplicates the smallest doc_id stays.
4. ``secret_scan``: secrets are masked in the text; ``n_chars`` follows.
5. ``packing``: the remaining documents, packed into sequences (one row per piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tephra.llm import compression_rules, packing, parity_join, quality_classifier, secret_scan
from tephra.llm.common import setup, table
from tephra.session import run_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return parity_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", classifier),
    ("near_duplicates", near_duplicates),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

# Compression ratios, a fitted model and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the stage results lie in the shared checkpoint folder."""
    docs = table(setup(spark), sf_dir, "documents")
    root = run_dir(spark, "corpus-pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
