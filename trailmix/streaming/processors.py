"""Streaming bodies of the keyed running operators.

Spark refuses ``lag`` and running window frames on streams, so the
streaming forms keep a small value per key in Spark's state store
(``applyInPandasWithState``) and fold each key's rows of a micro-batch
vectorised in numpy, seeded from that state:

  * action duration — state: open action and its start time;
  * repeat alert    — state: time of the key's last trigger record;
  * running sum     — state: the key's total so far.

``applyInPandasWithState`` hands the state to the function together with
the key's Arrow batches; the same folds on ``transformWithStateInPandas``
(one state-server round trip per state call) ran at half the rate.

Input frames are projected first to ``key`` columns, ``t`` (epoch
microseconds, BIGINT), ``seq`` (tie-break) and ``ord`` (arrival order, by
default the time), plus the operator's value column; ``keyed_input`` does
that.  Within one micro-batch a key's rows are put in ``(ord, seq)`` order;
across micro-batches, batch order is arrival order.  A key's rows of one micro-batch are the
memory bound — cap it with ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.
State is kept until the query is reset, as in the reference (no expiry).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmix.functions.time import duration_micros, epoch_micros
from trailmix.schemas import NO_ACTION, NO_ALERT


def keyed_input(df: DataFrame, keys: Sequence[str], time_col: str, seq: Column | str | None,
                extra: dict[str, Column | str], *, order: Column | str | None = None) -> DataFrame:
    """Project to the processors' input shape.  ``order`` is the arrival order
    (an offset, a sequence number), where it is not the time order."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    t = epoch_micros(df, time_col)
    s = F.lit(0) if seq is None else col(seq)
    cols = [F.col(k) for k in keys]
    cols += [t.alias("t"), s.cast("long").alias("seq"), (t if order is None else col(order).cast("long")).alias("ord")]
    cols += [col(v).alias(k) for k, v in extra.items()]
    return df.select(*cols)


def _ordered(pdfs: Iterator[pd.DataFrame], col: str):
    """The key's rows of this micro-batch as arrays in arrival order (ord, seq):
    the result does not depend on where a micro-batch ends."""
    chunks = list(pdfs)
    pdf = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
    t = pdf["t"].to_numpy(dtype="int64")
    seq = pdf["seq"].to_numpy(dtype="int64")
    idx = np.lexsort((seq, pdf["ord"].to_numpy(dtype="int64") if "ord" in pdf else t))
    return t[idx], seq[idx], pdf[col].to_numpy()[idx]


def _out(key_names: Sequence[str], key: tuple, n: int, **cols) -> pd.DataFrame:
    data = {name: np.full(n, key[i], dtype=object) for i, name in enumerate(key_names)}
    data.update(cols)
    return pd.DataFrame(data)


def action_duration_fold(key_names: Sequence[str], login: str, logout: str) -> Callable:
    """Publish (previous action, time since it) per record; see
    ``trailmix.operators.keyed.action_duration``."""
    def fold(key, pdfs, state):
        t, seq, action = _ordered(pdfs, "action")
        n = len(t)
        prev_a = np.empty(n, dtype=object)
        prev_t = np.zeros(n, dtype="int64")
        has = np.ones(n, dtype=bool)
        prev_a[1:], prev_t[1:] = action[:-1], t[:-1]
        if state.exists:
            prev_a[0], prev_t[0] = state.get
        else:
            has[0] = False
        ok = has & (prev_a != logout) & (action != login)
        if action[-1] == logout:
            state.remove()
        else:
            state.update((action[-1], int(t[-1])))
        yield _out(key_names, key, n, t=t, seq=seq,
                   last_action=np.where(ok, prev_a, NO_ACTION),
                   duration_us=np.where(ok, t - prev_t, 0).astype("int64"))
    return fold


def repeat_alert_fold(key_names: Sequence[str], trigger: str, threshold: str | int,
                      alerts_only: bool = True) -> Callable:
    """Alert when a key repeats ``trigger`` within ``threshold``."""
    limit = duration_micros(threshold)

    def fold(key, pdfs, state):
        t, seq, op = _ordered(pdfs, "op")
        hit = op == trigger
        # position of the last trigger before each row; none in this batch
        # -> the carried state (the previous trigger in arrival order)
        n = len(t)
        last_pos = np.maximum.accumulate(np.where(hit, np.arange(n), -1))
        before_pos = np.concatenate(([-1], last_pos[:-1]))
        in_batch = before_pos >= 0
        seed = int(state.get[0]) if state.exists else None
        before = np.where(in_batch, t[np.maximum(before_pos, 0)], seed if seed is not None else 0)
        known = in_batch | (seed is not None)
        gap = np.where(known, t - before, 0)
        fires = hit & known & (gap < limit)
        if hit.any():
            state.update((int(t[hit][-1]),))
        res = _out(key_names, key, n, t=t, seq=seq,
                   alert_user=np.where(fires, ",".join(str(k) for k in key if k is not None), NO_ALERT),
                   interval_us=np.where(fires, gap, 0).astype("int64"), is_alert=fires)
        yield res[res["is_alert"]] if alerts_only else res
    return fold


def running_sum_fold(key_names: Sequence[str]) -> Callable:
    """One output per record: the key's running total of ``value``."""
    def fold(key, pdfs, state):
        t, seq, value = _ordered(pdfs, "value")
        # A null adds nothing, and the total is null until a first value came.
        given = ~pd.isna(value)
        run = np.cumsum(np.where(given, value, 0).astype("int64")) + (int(state.get[0]) if state.exists else 0)
        known = np.logical_or.accumulate(given) | state.exists
        if known[-1]:
            state.update((int(run[-1]),))
        yield _out(key_names, key, len(t), t=t, seq=seq, value=pd.array(np.where(given, value, None), "Int64"),
                   running_total=pd.array(np.where(known, run, None), "Int64"))
    return fold


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType, True) for k in keys]


def _common(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return _key_fields(df, keys) + [T.StructField("t", T.LongType()), T.StructField("seq", T.LongType())]


def action_duration_stream(df: DataFrame, keys: Sequence[str], *, login: str, logout: str) -> DataFrame:
    """``df`` from ``keyed_input(..., extra={"action": ...})``."""
    schema = T.StructType(_common(df, keys) + [
        T.StructField("last_action", T.StringType()), T.StructField("duration_us", T.LongType())])
    return df.groupBy(*keys).applyInPandasWithState(
        action_duration_fold(keys, login, logout), schema, "action STRING, t BIGINT",
        "append", "NoTimeout")


def repeat_alert_stream(df: DataFrame, keys: Sequence[str], trigger: str, threshold: str | int,
                        *, alerts_only: bool = True) -> DataFrame:
    """``df`` from ``keyed_input(..., extra={"op": ...})``.  With
    ``alerts_only`` just the trigger records, the only ones that read or
    change the state, are shuffled."""
    if alerts_only:
        df = df.filter(F.col("op") == F.lit(trigger))
    schema = T.StructType(_common(df, keys) + [
        T.StructField("alert_user", T.StringType()), T.StructField("interval_us", T.LongType()),
        T.StructField("is_alert", T.BooleanType())])
    return df.groupBy(*keys).applyInPandasWithState(
        repeat_alert_fold(keys, trigger, threshold, alerts_only), schema, "t BIGINT",
        "append", "NoTimeout")


def running_sum_stream(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` from ``keyed_input(..., extra={"value": <integer column>})``;
    other types are refused (a sum of doubles depends on their order)."""
    if not isinstance(df.schema["value"].dataType, T.IntegralType):
        raise TypeError(f"running_sum_stream sums integers, not {df.schema['value'].dataType.simpleString()}")
    df = df.withColumn("value", F.col("value").cast("long"))
    schema = T.StructType(_common(df, keys) + [
        T.StructField("value", T.LongType()), T.StructField("running_total", T.LongType())])
    return df.groupBy(*keys).applyInPandasWithState(
        running_sum_fold(keys), schema, "total BIGINT", "append", "NoTimeout")
