"""Time helpers: epoch conversions, duration strings, window flattening."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "ms": 1_000,
    "second": 1_000_000,
    "s": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "h": 3_600_000_000,
    "day": 86_400_000_000,
    "d": 86_400_000_000,
    "week": 604_800_000_000,
}

_DURATION = re.compile(r"^\s*(\d+)\s*([a-z]+?)s?\s*$")


def duration_micros(d: str | int) -> int:
    """``"10 seconds"`` → 10_000_000.  Integers are taken as microseconds."""
    if isinstance(d, int):
        return d
    m = _DURATION.match(d.lower())
    if not m or m.group(2) not in _UNIT_MICROS:
        raise ValueError(f"cannot read duration {d!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def duration_string(d: str | int) -> str:
    """Normalise to the ``"<n> microseconds"`` form Spark's window accepts."""
    return f"{duration_micros(d)} microseconds"


_NTZ_EPOCH = datetime(1970, 1, 1)


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch for a TIMESTAMP, TIMESTAMP_NTZ or
    epoch-millisecond BIGINT column.

    TIMESTAMP_NTZ is measured from a TIMESTAMP_NTZ epoch, so the result does
    not depend on the session zone.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit(_NTZ_EPOCH).cast("timestamp_ntz"), F.col(col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.col(col).cast("long") * F.lit(1000)
    raise TypeError(f"column {col} has type {dtype}, not a time")


def micros_to_time(us: Column, dtype: T.DataType) -> Column:
    """Inverse of ``epoch_micros`` back to the original column type."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", us, F.lit(_NTZ_EPOCH).cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(us)
    return F.floor(us / F.lit(1000)).cast("long")


def flatten_window(df: DataFrame, col: str = "window",
                   prefix: str = "window") -> DataFrame:
    """Replace the ``window`` struct with ``window_start`` / ``window_end``."""
    rest = [c for c in df.columns if c != col]
    return df.select(
        F.col(f"{col}.start").alias(f"{prefix}_start"),
        F.col(f"{col}.end").alias(f"{prefix}_end"),
        *rest,
    )
