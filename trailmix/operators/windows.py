"""Window aggregations: tumbling, sliding and session windows.

Every function takes batch or streaming DataFrames; on a stream the caller
sets the watermark first (see ``trailmix.streaming.watermark``).  Counts,
minima and maxima are algebraic, so Spark aggregates each partition before
the exchange on the window key — a window or key holding a third of all
rows costs one partial row per task, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmix.functions.time import (duration_micros, duration_string, epoch_micros,
                                     flatten_window, micros_to_time)
from trailmix.operators.panes import sliding_agg
from trailmix.operators.sequence import (DEFAULT_BUCKET, DEFAULT_MAX_ROWS, _names, bucketed,
                                        order_key)


def _window(time_col: str, size: str, slide: str | None) -> Column:
    if slide is None:
        return F.window(time_col, duration_string(size))
    return F.window(time_col, duration_string(size), duration_string(slide))


def window_agg(df: DataFrame, time_col: str, size: str, aggs: Sequence[Column], *,
               slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Group rows by ``keys`` and a tumbling (or sliding) window of ``time_col``.

    Windows are ``[start, end)`` and aligned to the epoch.  Output columns:
    ``window_start, window_end, *keys, *aggs``.
    """
    grouped = df.groupBy(_window(time_col, size, slide).alias("window"), *keys).agg(*aggs)
    return flatten_window(grouped)


def window_count(df: DataFrame, time_col: str, size: str, *, slide: str | None = None,
                 keys: Sequence[str] = (), label: str | None = None,
                 out: str = "n") -> DataFrame:
    """Record count per window, over all keys unless ``keys`` is given.

    ``label`` adds a constant text column — the reference's labelled
    5-second counter.
    """
    res = window_agg(df, time_col, size, [F.count(F.lit(1)).alias(out)], slide=slide, keys=keys)
    if label is not None:
        res = res.withColumn("label", F.lit(label))
    return res


def window_count_first(df: DataFrame, time_col: str, size: str, carry: str,
                       order: Sequence[str], *, out: str = "n",
                       carry_out: str | None = None) -> DataFrame:
    """Count per window, keeping ``carry`` from the window's first record.

    "First" is the least ``order`` tuple (arrival order); the reference
    keeps the first record's field through its reduce.
    """
    if list(order) == [carry]:
        first = F.min(carry)
    else:
        first = F.min_by(F.col(carry), order_key(df, order))
    return window_agg(df, time_col, size, [
        F.count(F.lit(1)).alias(out),
        first.alias(carry_out or f"first_{carry}"),
    ])


def window_summary(df: DataFrame, time_col: str, size: str, *, slide: str | None = None,
                   keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Count, least and greatest ``value`` (default: the time itself) per window.

    Sliding windows of a batch are put together from panes (``panes.sliding_agg``).
    """
    v = value or time_col
    if slide is not None and not df.isStreaming:
        return sliding_agg(df, time_col, size, slide, {"n": ("*", "count"), f"min_{v}": (v, "min"), f"max_{v}": (v, "max")}, keys=keys)
    return window_agg(df, time_col, size, [
        F.count(F.lit(1)).alias("n"),
        F.min(v).alias(f"min_{v}"),
        F.max(v).alias(f"max_{v}"),
    ], slide=slide, keys=keys)


def session_summary(df: DataFrame, keys: str | Sequence[str], time_col: str, gap: str, *,
                    values: Sequence[str] = (), bucket: str | int = DEFAULT_BUCKET,
                    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                    hot: DataFrame | None = None) -> DataFrame:
    """Per-key sessions: a new session starts when the time since the key's
    previous record exceeds ``gap`` (a gap exactly equal to ``gap`` merges).

    Output: ``*keys, session_start, session_end, n`` and ``min_<v>, max_<v>``
    of each further column ``v`` in ``values``; ``session_start`` is the first
    record's time and ``session_end`` the last record's time plus ``gap``
    (Spark's session-window convention).

    Batch only.  Runs in two phases so one hot key is spread over its time
    buckets: sessions are cut inside each ``(key, bucket)`` and reduced there.
    A session that is neither its bucket's first nor its last is final.  Only
    the first and last one of each bucket go on to be glued across buckets.
    Streams use ``session_summary_stream``.
    """
    keys = _names(keys)
    gap_us = duration_micros(gap)
    timed = df.filter(F.col(time_col).isNotNull())
    base, bc = bucketed(timed, keys, time_col, bucket, max_rows_per_bucket, hot)
    base = base.select(*keys, *bc, epoch_micros(df, time_col).alias("__t"), *[F.col(v).alias(f"__v_{v}") for v in values])
    w = Window.partitionBy(*keys, *bc).orderBy("__t")
    prev = F.lag("__t").over(w)
    is_new = F.when(prev.isNull() | (F.col("__t") - prev > gap_us), 1).otherwise(0)
    local = base.withColumn("__new", is_new).withColumn(
        "__lsid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    def merged(rows, n, lo, hi):
        return [n, F.min(lo).alias("__first"), F.max(hi).alias("__end"),
                *[f(c(v)).alias(f"{how}_{v}") for v in values
                  for how, f, c in (("min", F.min, rows[0]), ("max", F.max, rows[1]))]]

    raw = (lambda v: f"__v_{v}",) * 2
    partial = local.groupBy(*keys, *bc, "__lsid").agg(*merged(raw, F.count(F.lit(1)).alias("n"), "__t", "__t"))
    partial = partial.withColumn("__nloc", F.max("__lsid").over(Window.partitionBy(*keys, *bc)))
    edge = (F.col("__lsid") == 1) | (F.col("__lsid") == F.col("__nloc"))
    across = Window.partitionBy(*keys).orderBy(*bc, "__lsid")
    before = F.lag("__end").over(across)
    starts = F.when(before.isNull() | (F.col("__first") - before > gap_us), 1).otherwise(0)
    edges = partial.filter(edge).withColumn("__start", starts).withColumn(
        "__sid", F.sum("__start").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    again = (lambda v: f"min_{v}", lambda v: f"max_{v}")
    glued = edges.groupBy(*keys, "__sid").agg(*merged(again, F.sum("n").alias("n"), "__first", "__end"))
    out = [*keys, "__first", "__end", "n", *[f"{how}_{v}" for v in values for how in ("min", "max")]]
    sessions = partial.filter(~edge).select(*out).unionByName(glued.select(*out))
    kind = df.schema[time_col].dataType
    return sessions.select(
        *keys,
        micros_to_time(F.col("__first"), kind).alias("session_start"),
        micros_to_time(F.col("__end") + F.lit(gap_us), kind).alias("session_end"),
        *out[len(keys) + 2:],
    )


def session_summary_stream(df: DataFrame, keys: str | Sequence[str], time_col: str,
                           gap: str) -> DataFrame:
    """The same summary with Spark's ``session_window`` (streams; also batch)."""
    keys = _names(keys)
    res = df.groupBy(*keys, F.session_window(time_col, duration_string(gap)).alias("s")).agg(
        F.count(F.lit(1)).alias("n"))
    return res.select(*keys, F.col("s.start").alias("session_start"),
                      F.col("s.end").alias("session_end"), "n")
