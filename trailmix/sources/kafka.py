"""Kafka topics as streams of text lines.

The Kafka connector is a separate package; without it on the classpath the
reader fails at ``load``.  ``lines_from_kafka_rows`` works on any frame
with Kafka's columns, so the parsing path is testable without a broker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_topic(spark: SparkSession, servers: str, topic: str, *, group_id: str | None = None,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to ``topic``; returns ``value STRING`` plus Kafka metadata."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return lines_from_kafka_rows(reader.load())


def lines_from_kafka_rows(rows: DataFrame) -> DataFrame:
    """Kafka rows (``key``/``value`` BINARY, ``timestamp``, ``partition``,
    ``offset``) → UTF-8 text lines.

    ``arrival_time`` is the processing time (one value per micro-batch, as for
    files); the broker's record time, which is not monotone over partitions,
    stays as ``broker_time``, and partition and offset give the arrival order.
    """
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("broker_time"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.current_timestamp().alias("arrival_time"),
    )


def kafka_payload(df: DataFrame, value: Column, key: Column) -> DataFrame:
    """``key`` and ``value`` as a Kafka sink takes them: UTF-8 bytes."""
    return df.select(key.cast("string").cast("binary").alias("key"),
                     value.cast("string").cast("binary").alias("value"))
