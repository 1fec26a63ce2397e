"""Sinks: text lines, Parquet, Kafka, console, memory, and two-branch writes.

Every streaming write takes a checkpoint location under the shared folder
named by ``spark.checkpoint.dir`` (``trailmix.session.checkpoint_location``)
so a restarted query resumes where it stopped and the file sinks commit
each micro-batch exactly once.  Kafka delivery is at-least-once; records
carry a deterministic key so consumers can drop repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmix.session import checkpoint_location
from trailmix.sources.kafka import kafka_payload


def _writer(df: DataFrame, name: str, mode: str, trigger: dict | None, checkpoint: str | None):
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, name)))
    return w.trigger(**(trigger or {"processingTime": "1 second"}))


def write_text(df: DataFrame, line: Column, path: str, name: str, *, mode: str = "append",
               trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """One text line per result row (e.g. ``tuple_text(first_ms, n)``)."""
    return _writer(df.select(line.alias("value")), name, mode, trigger, checkpoint) \
        .format("text").start(path)


def write_parquet(df: DataFrame, path: str, name: str, *, partition_by: tuple[str, ...] = (),
                  mode: str = "append", trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    w = _writer(df, name, mode, trigger, checkpoint).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def write_kafka(df: DataFrame, value: Column, key: Column, servers: str, topic: str, name: str, *,
                mode: str = "append", trigger: dict | None = None,
                checkpoint: str | None = None) -> StreamingQuery:
    """Send ``value`` text to ``topic`` (needs the Kafka connector package)."""
    return (_writer(kafka_payload(df, value, key), name, mode, trigger, checkpoint).format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic).start())


def write_console(df: DataFrame, name: str, *, mode: str = "append",
                  trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    return _writer(df, name, mode, trigger, checkpoint).format("console") \
        .option("truncate", "false").start()


def write_memory(df: DataFrame, name: str, *, mode: str = "append",
                 trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """In-memory table ``name`` — for tests and small interactive results."""
    return _writer(df, name, mode, trigger, checkpoint).format("memory").start()


def write_batches(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None], *,
                  mode: str = "append", trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Hand each micro-batch to ``fn(batch_df, batch_id)`` (alert delivery etc.).

    ``fn`` must be idempotent per ``batch_id``: a batch is replayed after a
    failure.
    """
    return _writer(df, name, mode, trigger, checkpoint).foreachBatch(fn).start()


def _refuse_foreign(spark, checkpoint: str, *paths: str) -> None:
    """Batch numbers restart with a new checkpoint, so writing by batch number
    into an older query's folder would overwrite its data."""
    hadoop = spark._jvm.org.apache.hadoop.fs

    def filled(path: str) -> bool:
        p = hadoop.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        return fs.exists(p) and len(fs.listStatus(p)) > 0

    for path in paths:
        if filled(path) and not filled(f"{checkpoint}/offsets"):
            raise ValueError(f"{path} holds data of another checkpoint than {checkpoint}")


def write_branches(df: DataFrame, predicate: Column, main_path: str, side_path: str,
                   name: str, *, side_cols: tuple[str, ...] | None = None,
                   trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Write both branches of a split from one query: each micro-batch is
    persisted once and filtered twice, so the source is read once.

    Files are written under ``<path>/batch=<id>`` and a replayed batch
    overwrites its own folder, so retries do not duplicate rows.  A folder that
    holds another checkpoint's data is refused.
    """
    hit = F.coalesce(predicate, F.lit(False))
    checkpoint = checkpoint or checkpoint_location(df.sparkSession, name)
    _refuse_foreign(df.sparkSession, checkpoint, main_path, side_path)

    def both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.filter(hit).write.mode("overwrite").parquet(f"{main_path}/batch={batch_id}")
            side = batch.filter(~hit)
            if side_cols:
                side = side.select(*side_cols)
            side.write.mode("overwrite").parquet(f"{side_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write_batches(df, name, both, trigger=trigger, checkpoint=checkpoint)


def observed(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Attach named metrics (default: row count) reported in query progress —
    the scalable stand-in for printing every received record."""
    return df.observe(name, *(metrics or (F.count(F.lit(1)).alias("rows"),)))
