"""Directory of text files as a batch or a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file under ``path`` (batch)."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None,
                 arrival: bool = True) -> DataFrame:
    """New files under ``path`` as a stream of lines.

    Spark's file source takes each new path once; a file modified after it
    was read is not read again.  ``arrival=True`` adds ``arrival_time`` —
    the micro-batch's processing time, Spark's counterpart of the
    reference's wall-clock stamp (one value per micro-batch).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    if arrival:
        df = df.withColumn("arrival_time", F.current_timestamp())
    return df
