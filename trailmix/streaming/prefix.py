"""Running values per key on a stream, with a hot key dealt over many tasks.

What a record's output needs of the records before it is often a *prefix* of
its key: the last record that satisfied a condition, or a sum.  Such prefixes
combine, so a key need not be one task's work.  In each micro-batch

1. rows are dealt by (key, slice of the arrival order) and scanned slice by
   slice with vectorised running operations; the scan gives every row its
   prefix within the slice, and one summary row per slice;
2. only summaries reach the key's state: the fold puts them in order, hands
   each slice the prefix that came before it and keeps the last;
3. rows take what their slice lacked from those by a join in the same batch.

A key with nearly all rows of a micro-batch is one state call and one summary
per slice; its rows are spread like any others.  ``slice_width`` (of the
order column's unit) should hold what one task can take of the hottest key.

    write_prefix(df, ["user"], "ord", "seq", {"prev": Last("op = 'Delete'", ["t"])}, result, path, name)

``result`` turns a frame with the columns ``<prefix>`` (a struct, null where
no such record came before; of a ``Sum`` a long) into the output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trailmix.session import checkpoint_location
from trailmix.streaming.sinks import _refuse_foreign, write_batches

SLICE_WIDTH = 60_000_000


@dataclass(frozen=True)
class Last:
    """Columns of the last record before this one for which ``where`` (an SQL
    condition) holds."""

    where: str
    cols: Sequence[str]


@dataclass(frozen=True)
class Sum:
    """Sum of a whole-number column over the records before this one (null
    until a value came)."""

    col: str


Prefix = Last | Sum
_ROW, _SUMMARY, _SEED = 0, 1, 2


def _fields(df: DataFrame, prefixes: dict[str, Prefix]) -> list[T.StructField]:
    """State columns: of a Last whether there is one and its columns, of a Sum
    whether a value came and the sum."""
    out = []
    for name, p in prefixes.items():
        out.append(T.StructField(f"{name}__has", T.BooleanType()))
        if isinstance(p, Last):
            out += [T.StructField(f"{name}__{c}", df.schema[c].dataType) for c in p.cols]
        else:
            out.append(T.StructField(f"{name}__sum", T.LongType()))
    return out


def _starts(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Where a run of rows equal in ``names`` begins (sorted rows)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for n in names:
        codes = pc.fill_null(table.column(n).combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _scan(keys: Sequence[str], order: Sequence[str], prefixes: dict[str, Prefix], names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.sort_by([(c, "ascending") for c in (*keys, "__slice", *order)])
        n = table.num_rows
        begin = _starts(table, [*keys, "__slice"])
        first = np.repeat(begin, np.diff(np.append(begin, n)))  # of each row's slice
        end = np.append(begin[1:], n) - 1
        at = np.arange(n)
        cols: dict[str, tuple[pa.Array, pa.Array]] = {}  # (of the rows, of the summaries)
        for name, p in prefixes.items():
            if isinstance(p, Last):
                hit = pc.fill_null(table.column(f"{name}__hit").combine_chunks(), False).to_numpy(zero_copy_only=False)
                upto = np.maximum.accumulate(np.where(hit, at, -1))
                before = np.concatenate([[-1], upto[:-1]])
                for where, low, which in ((before, first, 0), (upto[end], begin, 1)):
                    some = where >= low
                    index = pa.array(np.where(some, where, 0), mask=~some)
                    for c, a in ((f"{name}__has", pa.array(some)), *((f"{name}__{c}", table.column(c).combine_chunks().take(index)) for c in p.cols)):
                        cols[c] = (a, None) if which == 0 else (cols[c][0], a)
            else:
                column = table.column(p.col).combine_chunks().cast(pa.int64())
                given = column.is_valid().to_numpy(zero_copy_only=False)
                value = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
                total, count = np.cumsum(value), np.cumsum(given)
                zero, none = total[begin] - value[begin], count[begin] - given[begin]
                size = np.diff(np.append(begin, n))
                cols[f"{name}__has"] = (pa.array(count - given > np.repeat(none, size)), pa.array(count[end] > none))
                cols[f"{name}__sum"] = (pa.array(total - value - np.repeat(zero, size)), pa.array(total[end] - zero))
        own = [c for c in names if c not in cols and c != "__kind"]
        rows = {c: table.column(c).combine_chunks() for c in own} | {c: a for c, (a, _) in cols.items()} | {"__kind": pa.array(np.full(n, _ROW, np.int32))}
        yield pa.RecordBatch.from_arrays([rows[c] for c in names], list(names))
        m = len(begin)
        kept = {c: table.column(c).combine_chunks().take(pa.array(begin)) for c in (*keys, "__slice")}
        sums = {c: kept.get(c, pa.nulls(m, rows[c].type)) for c in own} | {c: a for c, (_, a) in cols.items()} | {"__kind": pa.array(np.full(m, _SUMMARY, np.int32))}
        yield pa.RecordBatch.from_arrays([sums[c] for c in names], list(names))

    return run


def _seeds(keys: Sequence[str], prefixes: dict[str, Prefix], fields: Sequence[str]):
    """Fold of a key's summaries: (slice, prefix before it) of each.  Values are
    text here: pandas would turn whole numbers beside nulls into doubles."""
    at = {c: i for i, c in enumerate(fields)}

    def fold(key, pdfs, state):
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("__slice")
        now = list(state.get) if state.exists else [False if c.endswith("__has") else None for c in fields]
        out = []
        for row in pdf[["__slice", *fields]].itertuples(index=False):
            out.append((row[0], *now))
            new = [v if isinstance(v, str) else bool(v) if c.endswith("__has") else None for c, v in zip(fields, row[1:], strict=True)]
            for name, p in prefixes.items():
                has = at[f"{name}__has"]
                if not new[has]:
                    continue
                if isinstance(p, Sum):
                    total = at[f"{name}__sum"]
                    now[total] = str(int(new[total]) + (int(now[total]) if now[has] else 0))
                else:
                    for c in p.cols:
                        now[at[f"{name}__{c}"]] = new[at[f"{name}__{c}"]]
                now[has] = True
        state.update(tuple(now))
        data = {k: pd.Series([key[i]] * len(out), dtype=object) for i, k in enumerate(keys)}
        data |= {c: pd.Series([o[i] for o in out], dtype=object) for i, c in enumerate(("__slice", *fields))}
        yield pd.DataFrame(data)

    return fold


def prefix_stream(df: DataFrame, keys: Sequence[str], order: str, tie: str, prefixes: dict[str, Prefix], *,
                  slice_width: int = SLICE_WIDTH) -> DataFrame:
    """Scanned rows and the seeds of their slices, told apart by ``__kind``;
    ``resolved`` joins them.  Rows of a key are in the order of ``order`` (a
    whole number), then ``tie``; a later micro-batch comes after an earlier one."""
    for p in prefixes.values():
        if isinstance(p, Sum) and not isinstance(df.schema[p.col].dataType, T.IntegralType):
            raise TypeError(f"sums whole numbers, not {df.schema[p.col].dataType.simpleString()}")
    marked = df.withColumn("__slice", F.floor(F.coalesce(F.col(order), F.lit(0)) / F.lit(slice_width)).cast("long"))
    marked = marked.withColumns({f"{n}__hit": F.expr(p.where) for n, p in prefixes.items() if isinstance(p, Last)})
    fields = _fields(df, prefixes)
    shape = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in marked.schema.fields if not f.name.endswith("__hit")),
                          *fields, T.StructField("__kind", T.IntegerType())])
    # A hash of key and slice: the same slices wherever this part of the plan runs.
    dealt = marked.repartition(*keys, "__slice").mapInArrow(_scan(keys, [order, tie], prefixes, shape.names), shape)
    names = [f.name for f in fields]
    text = [T.StructField(f.name, f.dataType if f.name.endswith("__has") else T.StringType()) for f in fields]
    seeded = T.StructType([*(T.StructField(k, df.schema[k].dataType, True) for k in keys), T.StructField("__slice", T.LongType()), *text])
    summaries = dealt.filter(F.col("__kind") == _SUMMARY).select(*keys, "__slice", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in text])
    seeds = summaries.groupBy(*keys).applyInPandasWithState(
        _seeds(keys, prefixes, names), seeded, T.StructType(text), "append", "NoTimeout")
    seeds = seeds.select(*keys, "__slice", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return dealt.filter(F.col("__kind") == _ROW).unionByName(
        seeds.withColumn("__kind", F.lit(_SEED)), allowMissingColumns=True)


def resolved(batch: DataFrame, keys: Sequence[str], prefixes: dict[str, Prefix]) -> DataFrame:
    """The rows of one micro-batch of ``prefix_stream`` with each prefix as a
    column of its name."""
    names = [c for c in batch.columns if any(c.startswith(f"{n}__") for n in prefixes)]
    rows = batch.filter(F.col("__kind") == _ROW).drop("__kind").alias("r")
    seeds = batch.filter(F.col("__kind") == _SEED).select(*keys, "__slice", *names).alias("s")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "__slice")]
    both = rows.join(seeds, on, "left")
    out = [F.col(f"r.{c}") for c in rows.columns if c not in names and c != "__slice"]
    for name, p in prefixes.items():
        mine, before = F.col(f"r.{name}__has"), F.coalesce(F.col(f"s.{name}__has"), F.lit(False))
        if isinstance(p, Last):
            def of(side, p=p, name=name):
                return F.struct(*[F.col(f"{side}.{name}__{c}").alias(c) for c in p.cols])
            out.append(F.when(mine, of("r")).when(before, of("s")).alias(name))
        else:
            total = F.col(f"r.{name}__sum") + F.coalesce(F.col(f"s.{name}__sum"), F.lit(0))
            out.append(F.when(mine | before, total).alias(name))
    return both.select(*out)


def write_prefix(df: DataFrame, keys: Sequence[str], order: str, tie: str, prefixes: dict[str, Prefix],
                 result: Callable[[DataFrame], DataFrame], path: str, name: str, *, slice_width: int = SLICE_WIDTH,
                 trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Write ``result`` of each micro-batch under ``<path>/batch=<id>``; a
    replayed batch replaces its own folder."""
    checkpoint = checkpoint or checkpoint_location(df.sparkSession, name)
    _refuse_foreign(df.sparkSession, checkpoint, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # rows and seeds come from one run of the state
        try:
            result(resolved(batch, keys, prefixes)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write_batches(prefix_stream(df, keys, order, tie, prefixes, slice_width=slice_width), name, write,
                         trigger=trigger, checkpoint=checkpoint)
