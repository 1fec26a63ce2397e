"""A user's reduce function per key and event-time window of a stream.

Each task reduces what it has read first, one row per (key, window), so a key's
state sees one row per task, window and micro-batch however hot it is.  The
state of a key is a map from window to accumulator.  An event-time timer at the
window's end publishes the window, once, and drops it from the state; records
of a window that the watermark has passed go nowhere (they are late, as in
Spark's own windows), so the state holds open windows only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

from trailmix.functions.time import duration_micros, duration_string

# Columns inside; pandas frames of grouped state take no leading underscore.
_START, _N, _ACC = "start_ms", "n_rows", "acc"


def _reduced(fn: Callable, keys: Sequence[str], value: str, start: str, schema: pa.Schema):
    """One row per (key, window) of what a task has read."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*keys, start, value)]
            for *at, v in zip(*cols, strict=True):
                found = held.get(tuple(at))
                if found is None:
                    held[tuple(at)] = [1, v]
                else:
                    found[0] += 1
                    found[1] = fn(found[1], v)
        if held:
            rows = [[*at, *found] for at, found in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


class _Windows(StatefulProcessor):
    def __init__(self, fn: Callable, size_ms: int, keys: Sequence[str], acc_ddl: str, plain: Callable):
        self.fn, self.size, self.keys, self.acc, self.plain = fn, size_ms, list(keys), acc_ddl, plain

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("windows", "start BIGINT", f"n BIGINT, acc {self.acc}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        new: dict[int, list] = {}
        for pdf in rows:
            for start, n, acc in zip(pdf[_START], pdf[_N], pdf[_ACC], strict=True):
                if start + self.size > passed:
                    new.setdefault(int(start), []).append((int(n), self.plain(acc)))
        for start, parts in new.items():
            if self.open.containsKey((start,)):
                parts.insert(0, tuple(self.open.getValue((start,))))
            else:
                self.handle.registerTimer(start + self.size)
            n, acc = sum(p[0] for p in parts), reduce(self.fn, [p[1] for p in parts])
            self.open.updateValue((start,), (n, acc))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        if self.open.containsKey((start,)):
            n, acc = self.open.getValue((start,))
            self.open.removeKey((start,))
            data = {k: pd.Series([v], dtype=object) for k, v in zip(self.keys, key, strict=True)}
            yield pd.DataFrame(data | {_START: [start], _N: [n], _ACC: pd.Series([acc], dtype=object)})

    def close(self) -> None:
        pass


def _plain(kind: T.DataType) -> Callable:
    """A state's value as Python's own."""
    if isinstance(kind, T.IntegralType):
        return int
    return {T.StringType: str, T.BooleanType: bool}.get(type(kind), float)


def window_reduce_stream(df: DataFrame, keys: Sequence[str], time_col: str, size: str, delay: str, value: str,
                         fn: Callable, *, out: str = "reduced") -> DataFrame:
    """``fn(a, b)`` over the ``value`` of each key's records in each tumbling
    window of ``time_col``: ``window_start, window_end, *keys, n, out``.

    ``fn`` is associative and commutative (tasks finish in any order) and returns
    what it takes: a whole number, float, text or truth value.  A record without a
    time or value is left out; a null key is a key.  Windows are published (mode
    append) once the watermark, ``delay`` behind the latest time, reaches their end.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType, T.StringType, T.BooleanType)):
        raise TypeError(f"column {value} of type {kind.simpleString()}: whole numbers, floats, texts and truth values only")
    size_ms = duration_micros(size) // 1000
    if size_ms <= 0 or duration_micros(size) % 1000:
        raise ValueError(f"window of {size}: whole milliseconds only")
    ms = F.unix_millis(time_col)
    rows = df.withWatermark(time_col, duration_string(delay)).filter(F.col(time_col).isNotNull() & F.col(value).isNotNull())
    group = [f"k{i}" for i in range(len(keys))]
    rows = rows.select(*[F.col(k).alias(g) for g, k in zip(group, keys, strict=True)],
                       (ms - F.pmod(ms, F.lit(size_ms))).alias(_START), F.col(value).alias(_ACC))
    key_fields = [T.StructField(g, df.schema[k].dataType) for g, k in zip(group, keys, strict=True)]
    partial = T.StructType([*key_fields, T.StructField(_START, T.LongType()), T.StructField(_N, T.LongType()), T.StructField(_ACC, kind)])
    once = rows.mapInArrow(_reduced(fn, group, _ACC, _START, to_arrow_schema(partial)), partial)
    found = once.groupBy(*group).transformWithStateInPandas(
        _Windows(fn, size_ms, group, kind.simpleString(), _plain(kind)), partial, "Append", "EventTime")
    return found.select(F.timestamp_millis(_START).alias("window_start"), F.timestamp_millis(F.col(_START) + size_ms).alias("window_end"),
                        *[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)], F.col(_N).alias("n"), F.col(_ACC).alias(out))
