"""Windows on processing time that close by the clock.

A watermark only moves when rows arrive, so with ``withWatermark`` the last
window before a silence stays open.  Here a window is what the operator's own
clock says (each micro-batch has one processing time, kept in the offset log,
so a replayed batch falls into the same window), and a processing-time timer at
the window's end publishes it: once, within a trigger of its end, whether more
rows come or not, and also after a restart, as window and timer are in the
state store.  No row is ever late.

Rows are combined before they are shuffled: each task sends one partial row per
key, so a key (or the window over all keys) costs the state one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from trailmix.functions.time import duration_micros

# How partial values of an aggregate combine, in Arrow and in the state.
_COMBINE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
_MERGE = {"sum": lambda a, b: a + b, "min": min, "max": max}
_ALL = "__all"


def _value(a):
    return a.item() if hasattr(a, "item") else a


class _Windows(StatefulProcessor):
    def __init__(self, size_ms: int, keys: Sequence[str], outs: Sequence[str], hows: Sequence[str], state: str):
        self.size, self.keys, self.outs, self.hows, self.state = size_ms, list(keys), list(outs), list(hows), state

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("window", self.state)

    def _row(self, key: tuple, window: tuple) -> pd.DataFrame:
        data = {k: pd.Series([v], dtype=object) for k, v in zip(self.keys, key, strict=True)}
        data |= {"start_ms": pd.Series([window[0]], dtype="int64"), "end_ms": pd.Series([window[0] + self.size], dtype="int64")}
        return pd.DataFrame(data | {o: pd.Series([v], dtype=object) for o, v in zip(self.outs, window[1:], strict=True)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size
        held = self.open.get() if self.open.exists() else None
        if held is not None and held[0] != start:
            # It has ended, and its timer would fire after these rows.
            self.handle.deleteTimer(held[0] + self.size)
            yield self._row(key, held)
            held = None
        if held is None:
            self.handle.registerTimer(start + self.size)
            values = [None] * len(self.outs)
        else:
            values = list(held[1:])
        for pdf in rows:
            for i, (out, how) in enumerate(zip(self.outs, self.hows, strict=True)):
                for v in pdf[out]:
                    if not pd.isna(v):
                        v = _value(v)
                        values[i] = v if values[i] is None else _MERGE[_COMBINE[how]](values[i], v)
        self.open.update((start, *values))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            held = self.open.get()
            self.open.clear()
            yield self._row(key, held)

    def close(self) -> None:
        pass


def _partial(keys: Sequence[str], outs: Sequence[str], hows: Sequence[str]):
    """One row per key of what a task has read (Arrow's own grouping)."""
    names = [*keys, *outs]
    step = [(o, _COMBINE[h]) for o, h in zip(outs, hows, strict=True)]

    def combined(table: pa.Table) -> pa.Table:
        done = table.group_by(list(keys)).aggregate(step)
        by_name = {f"{o}_{h}": o for o, h in step}
        return done.rename_columns([by_name.get(c, c) for c in done.column_names]).select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            part = combined(pa.Table.from_batches([b]).select(names))
            held = part if held is None else combined(pa.concat_tables([held, part]))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return run


def clock_window_agg(df: DataFrame, size: str, aggs: dict[str, tuple[str, str]], *, keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates per tumbling processing-time window of ``size`` (and key).

    ``aggs``: ``{name: (column, how)}``, how being count, sum, min or max of a
    whole-number, floating or boolean column; count takes any column and ignores
    its nulls ("*": all rows).  Output: ``window_start, window_end, *keys,
    *names``; only windows with rows.  Use an output mode of append and a
    processing-time trigger; ``availableNow`` ends with its last window open.
    """
    if bad := [h for _, h in aggs.values() if h not in _COMBINE]:
        raise ValueError(f"no combinable aggregate: {', '.join(bad)}")
    grouped = list(keys) or [_ALL]
    cols = [F.lit(0).alias(_ALL)] if not keys else [F.col(k) for k in keys]
    for name, (c, how) in aggs.items():
        if how == "count":
            cols.append((F.lit(1) if c == "*" else F.col(c).isNotNull().cast("long")).cast("long").alias(name))
            continue
        kind = df.schema[c].dataType
        if not isinstance(kind, (T.IntegralType, T.FractionalType, T.BooleanType)) or isinstance(kind, T.DecimalType):
            raise TypeError(f"column {c} of type {kind.simpleString()}: numbers only (a time as epoch milliseconds)")
        cols.append(F.col(c).cast("double" if isinstance(kind, T.FractionalType) else "long").alias(name))
    rows = df.select(*cols)
    outs, hows = list(aggs), [h for _, h in aggs.values()]
    partial = rows.mapInArrow(_partial(grouped, outs, hows), rows.schema)
    values = [rows.schema[o] for o in outs]
    state = ", ".join(["start BIGINT", *(f"v{i} {f.dataType.simpleString()}" for i, f in enumerate(values))])
    shape = T.StructType([*(rows.schema[k] for k in grouped), T.StructField("start_ms", T.LongType()), T.StructField("end_ms", T.LongType()), *values])
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in shape.fields])
    out = partial.groupBy(*grouped).transformWithStateInPandas(
        _Windows(duration_micros(size) // 1000, grouped, outs, hows, state), shape, "Append", "ProcessingTime")
    return out.select(F.timestamp_millis("start_ms").alias("window_start"), F.timestamp_millis("end_ms").alias("window_end"), *keys, *outs)
