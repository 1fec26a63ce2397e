"""Event time on streams, and running a query to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trailmix.functions.time import duration_string


def watermark(df: DataFrame, col: str, delay: str) -> DataFrame:
    return df.withWatermark(col, duration_string(delay))


def run_to_end(*queries: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until every (availableNow / once) query has finished; re-raise failures."""
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"query {q.name} did not finish in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
