"""User-code hooks for logic that built-in expressions cannot state.

The reference's user functions (map, filter, reduce, process, key
selector, join function) become Column expressions in almost every case —
those stay inside whole-stage code generation.  For the rest:

  * ``map_batches``  — per-partition pandas function (Arrow batches), for a
    map or a 0..n-rows-per-record process function;
  * ``reduce_udf``   — wrap an associative pandas reduction as a grouped
    aggregate usable in ``window_agg`` / ``groupBy().agg``;
  * ``reduce_by_key`` — the same reduction in two levels (per key and input
    partition, then per key), so a hot key is never one task's whole input;
  * ``to_bytes`` — text to bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema: T.StructType | str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of each partition (no shuffle)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def reduce_udf(fn: Callable[[pd.Series], object], return_type: T.DataType | str) -> Callable:
    """Grouped-aggregate pandas UDF from a function of one column's values.

    Prefer built-in aggregates: they combine map-side.  A pandas aggregate
    sees a whole group at once (no partial aggregation), so use it only for
    groups of bounded size (e.g. one key in one window).
    """
    @F.pandas_udf(return_type)
    def agg(values: pd.Series) -> object:  # type: ignore[override]
        return fn(values)
    return agg


def reduce_by_key(df: DataFrame, keys: Sequence[str], value: str,
                  fn: Callable[[pd.Series], object], return_type: T.DataType | str, *,
                  out: str = "reduced") -> DataFrame:
    """Per-key reduction by an associative ``fn`` whose result has the
    values' type (the reference's reduce: T, T -> T), skew-safe.

    Level one reduces each key within each input partition (the map-side
    combine a pandas aggregate lacks), so one group never holds more than
    one input partition's rows of a key.  Level two reduces those partials
    per key: at most one row per input partition.  Both levels are grouped
    pandas aggregates over Arrow batches.
    """
    agg = reduce_udf(fn, return_type)
    partial = df.groupBy(*keys, F.spark_partition_id().alias("__part")).agg(
        agg(F.col(value)).alias("__partial"))
    return partial.groupBy(*keys).agg(agg(F.col("__partial")).alias(out))


def to_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text column (e.g. a Kafka record value)."""
    return text.cast("string").cast("binary")
