"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tephra.llm import (
    bpe,
    compression_rules,
    conversation_trie,
    itq_dedup,
    packing,
    parity_join,
    periodic_runs,
    pii,
    quality_classifier,
    secret_scan,
    token_count,
    url_filter,
    voronoi_topk,
)
from tephra.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# URLs that make the list of op5: those that some page carries with a referral parameter.
REFERRED = "[?&]ref="


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    held_out = (quality_classifier.fold(F.col("doc_id")) == 0).alias("held_out")
    return quality_classifier.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs (without that parameter) of all pages reached by a referral, on any host."""
    return pages.filter(F.col("url").rlike(REFERRED)).select(url_filter.canonical_of(F.col("url")).alias("canonical"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_verdicts(pages, listed_urls(pages))


def op6_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("ids")
    return bpe.encode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        bpe.id_text_sha256(ids).alias("ids_sha256"),
        F.sha2(bpe.decode(ids), 256).alias("decoded_sha256"),
    )


def op11_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = voronoi_topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def with_planted_run(doc_id: int | None, text: bytes | None) -> bytes | None:
    """The text as the contract wants it: of every tenth document (by checksum) the words from some
    place on repeat with a period. Rows without an id stay as they are."""
    if doc_id is None or text is None:
        return text
    checksum = zlib.crc32(str(doc_id).encode())
    words = periodic_runs.text_words(text)
    if checksum % 10 or not words:
        return text
    g, n = checksum // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + i % period] for i in range(n - a)])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def planted(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = zip(ids, texts, strict=True)
        return pa.array([with_planted_run(i.as_py(), t.as_py()) for i, t in rows], pa.binary())

    plant = F.arrow_udf(planted, "binary").asNondeterministic()
    docs = table(spark, sf_dir, "documents").select("doc_id", plant("doc_id", F.col("text").cast("binary")).alias("text"))
    best = periodic_runs.best_run(F.col("runs")).alias("best")
    found = periodic_runs.find(docs).select("doc_id", "runs", "collapsed", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.try_divide(F.lit(1000) * F.col("best.length"), F.col("best.period"))).alias("exponent_milli"),
        periodic_runs.runs_sha256(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rebuilt(found: DataFrame) -> DataFrame:
    """``conv, turns`` as the contract wants them: the first h turns come from conversation c - c % 5."""
    family = F.col("conv") - F.col("conv") % 5
    rows = found.withColumn("family", family).withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).cast("int"))
    # At most nine conversations have one base; of its turns eight at most are wanted.
    own = F.when(F.col("conv") == F.col("family"), F.slice("turns", 1, 8))
    rows = rows.withColumn("base", F.first(own, ignorenulls=True).over(Window.partitionBy("family")))
    head = F.coalesce(F.slice("base", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv", F.concat(head, tail).alias("turns"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rebuilt(conversation_trie.sequences(table(spark, sf_dir, "conversations")))
    return conversation_trie.trie(found).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top, next to the package

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_secret_scan": op2_secret_scan,
        "op3_pii": op3_pii,
        "op4_token_counts": op4_token_counts,
        "op5_url_filter": op5_url_filter,
        "op6_itq_dedup": op6_itq_dedup,
        "op7_parity_join": op7_parity_join,
        "op8_compression_rules": op8_compression_rules,
        "op9_packing": op9_packing,
        "op10_bpe": op10_bpe,
        "op11_voronoi_topk": op11_voronoi_topk,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_conversation_trie": op13_conversation_trie,
        "pipeline": pipeline,
    }
