"""Sliding windows from panes.

``F.window`` with a slide copies every row into ``size / slide`` windows before
the exchange.  Here rows are aggregated once, per pane (the common divisor of
size and slide), and windows are put together from panes:

1. One row per (key, pane), combined map-side; nothing is copied.
2. Time is cut into blocks as long as a window, so a window touches at most two
   of them: the end of one and the beginning of the next.  Inside a block each
   pane gets the aggregate from itself to the block's end.
3. A window's start is named by the first pane in it, once.  It goes to the
   block where the window ends, and one running aggregate over that block's
   panes gives the other part.

No step holds more than one block's panes and window starts of a key in one
group, and rows made are as many as windows in the result (plus, for a block,
the starts that see only the block before it).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmix.functions.time import duration_micros, duration_string, epoch_micros, flatten_window, micros_to_time

# How an aggregate's partial values combine further.
_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _first(how: str, c: str) -> Column:
    if how == "count":
        return F.count(F.lit(1) if c == "*" else F.col(c))
    return {"sum": F.sum, "min": F.min, "max": F.max}[how](c)


def _join(how: str, a: Column, b: Column) -> Column:
    """Both parts of a window; a part without rows is null."""
    if how == "min":
        return F.least(a, b)
    if how == "max":
        return F.greatest(a, b)
    return F.coalesce(a + b, a, b)


def _floor(t: Column, step: int) -> Column:
    return t - F.pmod(t, F.lit(step))


def _ceil(t: Column, step: int) -> Column:
    return t + F.pmod(-t, F.lit(step))


def sliding_agg(df: DataFrame, time_col: str, size: str, slide: str, aggs: dict[str, tuple[str, str]], *,
                keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates per window of ``size`` starting at each multiple of ``slide``.

    ``aggs``: ``{name: (column, how)}``, how being count ("*": all rows), sum, min
    or max.  Output: ``window_start, window_end, *keys, *names``, the windows that
    hold rows, as ``F.window`` gives them.  Rows without a time are in no window;
    a null key is a key.  ``slide`` is at most ``size`` and need not divide it.

    On a stream (with a watermark, output mode append) panes are a first
    aggregation and windows a second one over its rows, so the state holds panes
    and windows, and each pane, not each row, is copied.
    """
    if bad := [h for _, h in aggs.values() if h not in _AGAIN]:
        raise ValueError(f"no combinable aggregate: {', '.join(bad)}")
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    if not 0 < slide_us <= size_us:
        raise ValueError(f"slide {slide} is not within 0 and {size}")
    pane = gcd(size_us, slide_us)
    firsts = [_first(how, c).alias(f"__a_{name}") for name, (c, how) in aggs.items()]
    if df.isStreaming:
        panes = df.groupBy(*keys, F.window(time_col, f"{pane} microseconds").alias("__pane")).agg(*firsts)
        again = [_AGAIN[how](f"__a_{name}").alias(name) for name, (_, how) in aggs.items()]
        return flatten_window(panes.groupBy(F.window("__pane", duration_string(size), duration_string(slide)).alias("window"), *keys).agg(*again))

    kind = df.schema[time_col].dataType
    group = [f"__k{i}" for i in range(len(keys))]
    parts = [f"__a_{name}" for name in aggs]
    hows = [how for _, how in aggs.values()]
    panes = (df.filter(F.col(time_col).isNotNull())
             .withColumns({"__p": _floor(epoch_micros(df, time_col), pane), **{g: F.col(k) for g, k in zip(group, keys, strict=True)}})
             .groupBy(*group, "__p").agg(*firsts).withColumn("__b", _floor(F.col("__p"), size_us)))

    # From a block's end to its start: a growing frame, one step a pane.
    block = Window.partitionBy(*group, "__b").orderBy(F.desc("__p"))
    to_end = block.rowsBetween(Window.unboundedPreceding, 0)
    p, b = F.col("__p"), F.col("__b")
    seen = panes.withColumns({f"__s{i}": _AGAIN[how](a).over(to_end) for i, (a, how) in enumerate(zip(parts, hows, strict=True))}) \
        .withColumn("__q", F.lead("__p").over(block))
    # Starts whose first pane is this one, in this block; and, from a block's first
    # pane, those in the block before it that may see no pane of their own.
    own = _ceil(F.greatest(F.coalesce(F.col("__q") + pane, b), p - (size_us - pane), b), slide_us)
    spans = [F.struct(p.alias("lo"), p.alias("hi"), F.lit(0).alias("kind")),
             F.struct(own.alias("lo"), _floor(p, slide_us).alias("hi"), F.lit(1).alias("kind")),
             F.struct(_ceil(p - (size_us - pane), slide_us).alias("lo"),
                      F.when(F.col("__q").isNull(), _floor(b - 1, slide_us)).alias("hi"), F.lit(2).alias("kind"))]
    suffix = [f"__s{i}" for i in range(len(parts))]
    spread = seen.select(*group, *suffix, *parts, F.explode(F.array(*spans)).alias("__r")).filter("__r.lo <= __r.hi")
    starts = spread.select(*group, F.explode(F.sequence("__r.lo", "__r.hi", F.lit(slide_us))).alias("__w"),
                           F.col("__r.kind").alias("__kind"), *suffix, *parts)
    # A pane (kind 0) stands at its place, a window's start at the window's last pane.
    at = F.when(F.col("__kind") == 0, F.col("__w")).otherwise(F.col("__w") + (size_us - pane))
    # A window that is a whole block has no part before it.
    whole = F.pmod(F.col("__w"), F.lit(size_us)) == 0
    events = starts.select(*group, "__w", "__kind", at.alias("__p"), _floor(at, size_us).alias("__b"),
                           *[F.when((F.col("__kind") == 1) & ~whole, F.col(c)).alias(c) for c in suffix],
                           *[F.when(F.col("__kind") == 0, F.col(a)).alias(a) for a in parts])

    line = Window.partitionBy(*group, "__b").orderBy("__p", "__kind")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    done = events.withColumns({
        **{f"__f{i}": _AGAIN[how](a).over(so_far) for i, (a, how) in enumerate(zip(parts, hows, strict=True))},
        "__named": F.coalesce((F.lag("__kind").over(line) == 1) & (F.lag("__w").over(line) == F.col("__w")), F.lit(False))})
    done = done.filter((F.col("__kind") == 1) | ((F.col("__kind") == 2) & ~F.col("__named")))
    values = [_join(how, F.col(f"__s{i}"), F.col(f"__f{i}")).alias(name) for i, (name, how) in enumerate(zip(aggs, hows, strict=True))]
    return done.select(micros_to_time(F.col("__w"), kind).alias("window_start"), micros_to_time(F.col("__w") + size_us, kind).alias("window_end"),
                       *[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)], *values)
