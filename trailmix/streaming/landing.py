"""Read, parse and stamp a source once; every output reads what has landed.

A job with several outputs would otherwise run one query for each, and every
query would read and parse the source again and stamp its own arrival times,
so two outputs could disagree on whether a record was late.  ``land`` starts
one query that parses the lines and writes good and bad ones, with one
``arrival_time`` for each record, to Parquet by arrival date and hour (Spark's
file sink commits each micro-batch exactly once, and a replayed micro-batch
keeps its time).  The outputs stream from that folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trailmix.sources.lines import split_staged, staged_lines
from trailmix.streaming import sinks
from trailmix.streaming.stream import run_to_end

PARTS = ("arrival_date", "arrival_hour")


def land(lines: DataFrame, fields: Sequence[tuple[str, T.DataType]], path: str, name: str, *,
         trigger: dict | None = None, checkpoint: str | None = None,
         keep: Sequence[str] = ("arrival_time",)) -> tuple[DataFrame, DataFrame, StreamingQuery]:
    """(parsed stream, rejects stream, landing query).

    With a trigger that ends by itself (``availableNow``, ``once``) the landing
    query has ended on return, so that outputs started next see all of it.
    """
    spark = lines.sparkSession
    staged = staged_lines(lines, fields, keep=keep)
    schema = staged.schema
    dated = staged.withColumns({PARTS[0]: F.to_date("arrival_time"), PARTS[1]: F.hour("arrival_time")})
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    query = sinks.write_parquet(dated, path, name, partition_by=PARTS, trigger=trigger, checkpoint=checkpoint)
    if trigger and (trigger.get("availableNow") or trigger.get("once")):
        run_to_end(query)
    dated_schema = schema.add(PARTS[0], T.DateType()).add(PARTS[1], T.IntegerType())
    landed = spark.readStream.schema(dated_schema).parquet(path).drop(*PARTS)
    parsed, rejects = split_staged(landed, fields, keep=keep)
    return parsed, rejects, query
