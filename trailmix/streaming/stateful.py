"""Keyed state written by the user.

A ``KeyedFunction`` names its value states and processes one record at a time:

    class Repeats(KeyedFunction):
        states = {"last": "t BIGINT"}
        output = "t BIGINT, gap BIGINT"

        def process(self, key, row, state):
            if row.op == "Delete":
                if state.last.exists():
                    yield row.t, row.t - state.last.get()[0]
                state.last.update((row.t,))

``apply_keyed`` runs it per key in arrival order, on a stream with its states in
the state store (checkpointed with the query's offsets, so a restart goes on
where it stopped), or on a batch frame with empty states.  A state is read from
the store at most once and written at most once per key and micro-batch, however
many records there are.  ``initial`` gives states from a batch table on a
query's first start.

A key's records of one micro-batch are processed one after the other, which is
what such code asks for.  A fold that combines (last value, sum) can go to
``trailmix.streaming.prefix`` instead, which deals a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor


class Value:
    """One key's value of one state: ``get`` (a tuple or None), ``update``,
    ``clear``, ``exists``."""

    def __init__(self, store=None):
        self._store, self._read, self._dirty, self._value = store, store is None, False, None

    def _load(self) -> None:
        if not self._read:
            self._value = self._store.get() if self._store.exists() else None
            self._read = True

    def exists(self) -> bool:
        self._load()
        return self._value is not None

    def get(self) -> tuple | None:
        self._load()
        return self._value

    def update(self, value: tuple) -> None:
        self._value, self._read, self._dirty = tuple(value), True, True

    def clear(self) -> None:
        self._value, self._read, self._dirty = None, True, True

    def save(self) -> None:
        if self._dirty:
            if self._value is None:
                self._store.clear()
            else:
                self._store.update(self._value)


class States:
    """A key's states as attributes."""

    def __init__(self, values: dict[str, Value]):
        self.__dict__.update(values)


class KeyedFunction:
    """Subclass with ``states`` (name -> DDL of its fields), ``output`` (DDL of
    what ``process`` yields) and ``process``; ``start`` takes a row of the
    initial table."""

    states: dict[str, str] = {}
    output: str = ""

    def process(self, key: tuple, row, state: States) -> Iterator[tuple]:
        raise NotImplementedError

    def start(self, key: tuple, row, state: States) -> None:
        raise NotImplementedError


def _frames(found: list[tuple], key: tuple, keys: Sequence[str], names: Sequence[str]) -> pd.DataFrame:
    data = {k: pd.Series([key[i]] * len(found), dtype=object) for i, k in enumerate(keys)}
    data |= {c: pd.Series([f[i] for f in found], dtype=object) for i, c in enumerate(names)}
    return pd.DataFrame(data)


def _texts(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Whole-number columns as text, and their names: beside nulls pandas would
    make doubles of them."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType) and f.nullable and f.name not in keys]
    return df.withColumns({c: F.col(c).cast("string") for c in whole}), whole


def _plain(pdf: pd.DataFrame, whole: Sequence[str]) -> pd.DataFrame:
    """Values as Python's own, missing ones as None."""
    out = pdf.astype(object)
    out = out.where(~pdf.isna(), None)
    for c in whole:
        out[c] = pd.Series([None if v is None else int(v) for v in out[c]], dtype=object, index=out.index)
    return out


def _in_order(pdf: pd.DataFrame, order: Sequence[str]) -> pd.DataFrame:
    at = sorted(range(len(pdf)), key=lambda i: [(v is not None, v) for v in (pdf[c].iloc[i] for c in order)])
    return pdf.iloc[at]


class _Processor(StatefulProcessor):
    def __init__(self, function: KeyedFunction, keys: Sequence[str], names: Sequence[str], order: Sequence[str],
                 whole: Sequence[str], whole_initial: Sequence[str]):
        self.function, self.keys, self.names, self.order = function, list(keys), list(names), list(order)
        self.whole, self.whole_initial = list(whole), list(whole_initial)

    def init(self, handle) -> None:
        self.stores = {n: handle.getValueState(n, ddl) for n, ddl in self.function.states.items()}

    def _states(self) -> dict[str, Value]:
        return {n: Value(s) for n, s in self.stores.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _in_order(_plain(pd.concat(list(rows), ignore_index=True), self.whole), self.order)
        values = self._states()
        found = [f for row in pdf.itertuples(index=False) for f in self.function.process(key, row, States(values)) or ()]
        for v in values.values():
            v.save()
        if found:
            yield _frames(found, key, self.keys, self.names)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        values = self._states()
        for row in _plain(initialState, self.whole_initial).itertuples(index=False):
            self.function.start(key, row, States(values))
        for v in values.values():
            v.save()

    def close(self) -> None:
        pass


def apply_keyed(df: DataFrame, keys: Sequence[str], function: KeyedFunction, order: Sequence[str], *,
                initial: DataFrame | None = None) -> DataFrame:
    """``function`` over each key's records in ``order`` (arrival order):
    ``*keys`` and the function's output.  ``initial`` (streams only) is a batch
    frame with the key columns."""
    out = T._parse_datatype_string(function.output)
    shape = T.StructType([*(T.StructField(k, df.schema[k].dataType, True) for k in keys), *out.fields])
    names = [f.name for f in out.fields]
    rows, whole = _texts(df, keys)
    if df.isStreaming:
        begin, whole_initial = (None, []) if initial is None else _texts(initial, keys)
        return rows.groupBy(*keys).transformWithStateInPandas(
            _Processor(function, keys, names, order, whole, whole_initial), shape, "Append", "None",
            initialState=None if begin is None else begin.groupBy(*keys))
    if initial is not None:
        raise ValueError("initial states belong to a stream")

    def once(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = {n: Value() for n in function.states}
        found = [f for row in _in_order(_plain(pdf, whole), order).itertuples(index=False) for f in function.process(key, row, States(values)) or ()]
        return _frames(found, key, keys, names)

    return rows.groupBy(*keys).applyInPandas(once, shape)
