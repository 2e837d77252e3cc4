"""Kafka message source: ``value`` bytes of a topic as a string column.

The Kafka connector is not bundled with PySpark; add
``org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>`` to
``spark.jars.packages`` on the cluster. :func:`kafka_options` is pure and
can be checked without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Topics and consumer group of the original deployment.
FIRES_TOPIC = "fires-topic"
QUAKES_TOPIC = "earthquakes-topic"
FIRES_GROUP_ID = "fire_stream_consumer"


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        # Caps one micro-batch, so a backlog is drained in bounded steps.
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        # Splits the offset range of a busy topic partition over several tasks,
        # so one hot partition does not become one long task.
        opts["minPartitions"] = str(min_partitions)
    return opts


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Streaming DataFrame with one string column ``value`` (NULL payloads dropped)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return raw.select(F.col("value").cast("string").alias("value")).where(
        F.col("value").isNotNull()
    )


def fire_messages(spark: SparkSession, bootstrap_servers: str, **kw) -> DataFrame:
    kw.setdefault("group_id", FIRES_GROUP_ID)
    return kafka_stream(spark, bootstrap_servers=bootstrap_servers, topic=FIRES_TOPIC, **kw)


def quake_messages(spark: SparkSession, bootstrap_servers: str, **kw) -> DataFrame:
    return kafka_stream(spark, bootstrap_servers=bootstrap_servers, topic=QUAKES_TOPIC, **kw)
