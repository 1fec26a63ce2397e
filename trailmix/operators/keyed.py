"""Keyed running operators: running sum, repeat-delete alert, action duration.

These are the batch bodies.  The reference keeps a value per user and
updates it record by record; in batch the same answer comes from ordered
window functions over each user's records (``order`` = arrival order, made
explicit), run through the two-phase scans of ``sequence`` so a hot user is
spread over many tasks.  Streaming bodies live in
``trailmix.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmix.functions.time import duration_micros, epoch_micros
from trailmix.operators.sequence import DEFAULT_BUCKET, DEFAULT_MAX_ROWS, _names, previous_in_key, running_agg
from trailmix.schemas import NO_ACTION, NO_ALERT


def running_sum(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], value: str,
                *, out: str = "running_total", bucket: str | int = DEFAULT_BUCKET,
                max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                 hot: DataFrame | None = None) -> DataFrame:
    """One output row per input row: the key's sum of ``value`` so far.

    The reference names this a running count but sums a field; a count is
    ``running_sum`` of a column of ones.  Sum integer columns when the
    result must be exact — a double sum depends on addition order.
    """
    keys = _names(keys)
    return running_agg(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, value,
                       out, agg="sum", bucket=bucket, max_rows_per_bucket=max_rows_per_bucket, hot=hot)


def repeat_alert(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], op_col: str,
                 trigger: str, threshold: str | int, *, time_col: str | None = None,
                 alerts_only: bool = True, bucket: str | int = DEFAULT_BUCKET,
                 max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                 hot: DataFrame | None = None) -> DataFrame:
    """Alert when a key repeats ``trigger`` within ``threshold`` of its previous
    ``trigger`` record (strictly less; compared in microseconds).

    "Previous" is in ``order`` (arrival order), which need not be time
    order: a trigger that arrives after a later-stamped one gives a
    negative interval, which alerts.  ``time_col`` (default ``order[0]``)
    supplies the times.

    ``alerts_only=True`` (default): one row per alert —
    ``*keys, *order, interval_us``.  Only trigger rows can alert and only
    they update the "previous" time, so the filter is pushed below the scan.

    ``alerts_only=False``: one row per input, as the reference's map emits —
    ``*keys, *order, alert_user, interval_us, is_alert`` with
    ``alert_user = "No Alerts"`` and ``interval_us = 0`` where nothing fires.
    """
    keys = _names(keys)
    time_col = time_col or order[0]
    limit = duration_micros(threshold)
    base = df.select(*dict.fromkeys([*keys, *order, time_col, op_col]))
    t = epoch_micros(base, time_col)
    is_trigger = F.coalesce(F.col(op_col) == F.lit(trigger), F.lit(False))
    if alerts_only:
        base = base.filter(F.col(op_col) == F.lit(trigger))  # pushed to the scan
        # Every row is a trigger, so the last trigger is the previous row.
        scanned = previous_in_key(base.withColumn("__t", t), keys, order, ["__t"], prefix="__p_", bucket=bucket,
                                  max_rows_per_bucket=max_rows_per_bucket, hot=hot).withColumnRenamed("__p___t", "__prev")
    else:
        marked = base.withColumn("__t", F.when(is_trigger, t))
        scanned = running_agg(marked, keys, order, "__t", "__prev",
                              agg="last", inclusive=False, bucket=bucket,
                              max_rows_per_bucket=max_rows_per_bucket, hot=hot)
    gap = F.col("__t") - F.col("__prev")
    fires = F.col("__prev").isNotNull() & F.col("__t").isNotNull() & (gap < limit)
    if alerts_only:
        return scanned.filter(fires).select(*keys, *order, gap.alias("interval_us"))
    label = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    return scanned.select(
        *keys, *order,
        F.when(fires, label).otherwise(F.lit(NO_ALERT)).alias("alert_user"),
        F.when(fires, gap).otherwise(F.lit(0).cast("long")).alias("interval_us"),
        fires.alias("is_alert"),
    )


def action_duration(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                    action_col: str, *, login: str, logout: str,
                    time_col: str | None = None, bucket: str | int = DEFAULT_BUCKET,
                    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                 hot: DataFrame | None = None) -> DataFrame:
    """How long each user spent on each action.

    Per record, publish the key's previous action and the time since it,
    unless there is no open action (no previous record, or it was
    ``logout``) or the current record is ``login`` — then publish
    ``"None"`` and 0.  A ``logout`` closes the open action; any other
    action opens a new one.

    ``order`` is arrival order; ``time_col`` (default ``order[0]``)
    supplies the times.  Output: ``*keys, *order, last_action, duration_us``.
    """
    keys = _names(keys)
    time_col = time_col or order[0]
    base = df.select(*dict.fromkeys([*keys, *order, time_col, action_col]))
    base = base.withColumn("__t", epoch_micros(base, time_col))
    prev = previous_in_key(base, keys, order, [action_col, "__t"], prefix="__p_", bucket=bucket,
                           max_rows_per_bucket=max_rows_per_bucket, hot=hot)
    open_action = F.col(f"__p_{action_col}")
    ok = (F.col(f"__p___t").isNotNull()
          & F.coalesce(open_action != F.lit(logout), F.lit(True))
          & F.coalesce(F.col(action_col) != F.lit(login), F.lit(True)))
    return prev.select(
        *keys, *order,
        F.when(ok, open_action).otherwise(F.lit(NO_ACTION)).alias("last_action"),
        F.when(ok, F.col("__t") - F.col("__p___t")).otherwise(F.lit(0).cast("long"))
         .alias("duration_us"),
    )


def duration_by_action(durations: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Summary of ``action_duration`` output: count, total and mean per action."""
    # The mean is the exact integer total over the count, not a running
    # double average, so it does not depend on addition order.
    res = durations.groupBy(*keys, "last_action").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("duration_us").alias("total_us"),
    )
    return res.withColumn("mean_us", F.col("total_us") / F.col("n"))
