"""Route late records to their own output instead of dropping them.

The reference assigns a watermark that follows the wall clock: it is
refreshed to "now" at most every ``refresh`` and trails it by ``buffer``;
a record whose event-time window has already closed under the watermark in
force when the record arrives goes to a late side output.

Spark only drops late rows.  We replace the sequential watermark by a
per-row expression of the record's arrival time,

    watermark(arrival) = floor(arrival / refresh) * refresh - buffer
    late               = window_end - 1 ms <= watermark(arrival)

which lags arrival by ``buffer`` to ``refresh + buffer`` exactly like the
reference but with refresh points aligned to the epoch (an approximation
of its record-driven refresh points).  Being stateless, the split runs
partition-parallel on batches and streams.  On a stream the on-time branch
then takes Spark's own watermark of ``refresh + buffer``; every row this
predicate calls on time survives Spark's dropping when event time does not
run ahead of arrival time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.functions.time import duration_micros, epoch_micros

ONE_MS = 1_000


def watermark_at(arrival_us: Column, refresh: str | int, buffer: str | int) -> Column:
    r = F.lit(duration_micros(refresh))
    return arrival_us - F.pmod(arrival_us, r) - F.lit(duration_micros(buffer))


def late_flag(df: DataFrame, time_col: str, arrival_col: str, size: str,
              refresh: str | int, buffer: str | int) -> Column:
    """True where the record's tumbling window of ``size`` had closed when it
    arrived; false where one of the two times is null (nothing shows it late)."""
    w = F.lit(duration_micros(size))
    t = epoch_micros(df, time_col)
    window_end = t - F.pmod(t, w) + w
    closed = (window_end - F.lit(ONE_MS)) <= watermark_at(epoch_micros(df, arrival_col), refresh, buffer)
    return F.coalesce(closed, F.lit(False))


def split_late(df: DataFrame, time_col: str, arrival_col: str, size: str,
               refresh: str | int, buffer: str | int) -> tuple[DataFrame, DataFrame]:
    """(on_time, late); together they hold every input row exactly once."""
    flagged = df.withColumn("__late", late_flag(df, time_col, arrival_col, size, refresh, buffer))
    return (flagged.filter(~F.col("__late")).drop("__late"),
            flagged.filter(F.col("__late")).drop("__late"))


def spark_watermark_delay(refresh: str | int, buffer: str | int) -> str:
    """Delay for ``withWatermark`` on the on-time branch."""
    return f"{duration_micros(refresh) + duration_micros(buffer)} microseconds"
