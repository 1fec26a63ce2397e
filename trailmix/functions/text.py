"""String formatting used by the reference's printing and sink maps.

All of these are built-in Column expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_text(ts: Column) -> Column:
    """Time of day as ``HH:mm:ss`` (session zone)."""
    return F.date_format(ts, "HH:mm:ss")


def date_text(ts: Column) -> Column:
    """Long date text, e.g. ``Mon Jan 01 00:00:07 UTC 2024``."""
    return F.date_format(ts, "EEE MMM dd HH:mm:ss zzz yyyy")


def key_equals_value(key: Column, value: Column) -> Column:
    """``"<key> = <value>"`` — the record text sent to the sink topic."""
    return F.concat_ws(" = ", key.cast("string"), value.cast("string"))


def tuple_text(*cols: Column) -> Column:
    """``"(a,b,...)"`` — how a result tuple prints as a line of text."""
    return F.concat(F.lit("("), F.concat_ws(",", *[c.cast("string") for c in cols]), F.lit(")"))


def join_fields(*cols: Column, sep: str = ",") -> Column:
    """Record → one comma-separated line (inverse of the line parsers)."""
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def quote_fields(*cols: Column, sep: str = ",") -> Column:
    """Record → line with every field in double quotes (CSV writer style)."""
    return F.concat_ws(sep, *[F.concat(F.lit('"'), c.cast("string"), F.lit('"')) for c in cols])
