"""Windowed inner equi-join of two streams.

The reference joins two streams on user within the same tumbling window
and emits ``(user, 1)`` for every matching pair.  Emitting each pair costs
``n_left * n_right`` rows per (user, window) — a hot user makes that
quadratic.  The output carries nothing from the individual records, so we
emit one row per (user, window) with the number of pairs instead.

It is computed without a join at all: both sides are tagged and unioned,
then one aggregation on (key, window) counts each side.  That aggregation
combines map-side, runs unchanged on streams (one stateful operator with a
watermark), and never holds a group's rows in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.functions.time import flatten_window
from trailmix.operators.windows import _window


# Aggregates of one side that a join result may carry: they combine map-side.
SIDE_AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum}
SideValues = dict[str, tuple[Column | str, str]]


def _keyed(df: DataFrame, key: Column | str, time_col: str, side: int,
           own: SideValues, other: SideValues) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    values = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, (c, _) in own.items()]
    return df.select(k.alias("__key"), F.col(time_col).alias("__time"), F.lit(side).alias("__side"),
                     *values, *[F.lit(None).alias(n) for n in other])


def window_join_pairs(left: DataFrame, right: DataFrame, left_key: Column | str,
                      right_key: Column | str, left_time: str, right_time: str, size: str,
                      *, key_out: str = "key", left_values: SideValues | None = None,
                      right_values: SideValues | None = None) -> DataFrame:
    """Pairs per (key, window) of the inner join ``left.key == right.key``
    within the same tumbling window of ``size``.

    Keys may be column names or expressions (key selectors).  Output:
    ``window_start, window_end, <key_out>, left_n, right_n, pairs``; only
    windows where both sides have rows appear, as in an inner join.  Null
    keys never match.

    ``left_values`` and ``right_values`` carry something of each side into the
    result without making pairs: ``{name: (column or expression, "min" | "max"
    | "sum")}`` over that side's rows of the (key, window).
    """
    lv, rv = left_values or {}, right_values or {}
    both = _keyed(left, left_key, left_time, 1, lv, rv).unionByName(_keyed(right, right_key, right_time, 0, rv, lv))
    both = both.filter(F.col("__key").isNotNull())
    agg = both.groupBy(_window("__time", size, None).alias("window"), "__key").agg(
        F.sum("__side").alias("left_n"),
        F.sum(1 - F.col("__side")).alias("right_n"),
        *[SIDE_AGGREGATES[how](name).alias(name) for name, (_, how) in {**lv, **rv}.items()],
    )
    out = agg.filter((F.col("left_n") > 0) & (F.col("right_n") > 0)).select(
        "window", F.col("__key").alias(key_out),
        F.col("left_n").cast("long").alias("left_n"),
        F.col("right_n").cast("long").alias("right_n"),
        (F.col("left_n") * F.col("right_n")).cast("long").alias("pairs"),
        *lv, *rv,
    )
    return flatten_window(out)


def window_join_totals(pairs: DataFrame, key: str = "key") -> DataFrame:
    """Sum of the reference's per-pair ``1`` per key: pairs over all windows."""
    return pairs.groupBy(key).agg(F.sum("pairs").alias("pairs"),
                                  F.count(F.lit(1)).alias("windows"))
