"""Split one stream by a predicate and merge streams with an origin tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.functions.time import flatten_window
from trailmix.operators.windows import _window
from trailmix.schemas import STREAM_TAGS


def _holds(predicate: Column) -> Column:
    # A record whose predicate is null goes to the side branch: the
    # reference sends everything that is not a match there.
    return F.coalesce(predicate, F.lit(False))


def split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(main, side): rows where ``predicate`` holds, and all other rows.

    Two filters over one parent plan.  When both branches are written by
    one streaming query, write them from a single ``foreachBatch`` over a
    persisted batch (see ``trailmix.streaming.sinks.write_branches``) so
    the source is read once.
    """
    # Written without coalesce so both filters reach the Parquet scan.
    return df.filter(predicate), df.filter(predicate.isNull() | ~predicate)


def split_records(df: DataFrame, predicate: Column, key: str, *,
                  side_value: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The reference's split: main keeps whole records; side keeps
    ``(key, n=1)`` only."""
    main, side = split(df, predicate)
    side = side.select(key, (side_value if side_value is not None else F.lit(1)).alias("n"))
    return main, side


def branch(predicate: Column, tags: Sequence[str] = STREAM_TAGS) -> Column:
    """Branch label per row: ``tags[0]`` where the predicate holds."""
    return F.when(_holds(predicate), F.lit(tags[0])).otherwise(F.lit(tags[1]))


def branch_counts(df: DataFrame, predicate: Column, time_col: str, size: str, *,
                  tags: Sequence[str] = STREAM_TAGS) -> DataFrame:
    """Count of each branch per tumbling window, in one aggregation.

    The reference runs one windowed counter per branch; a single group-by on
    (window, branch) reads the input once.
    """
    res = df.groupBy(_window(time_col, size, None).alias("window"),
                     branch(predicate, tags).alias("stream_tag")).agg(
        F.count(F.lit(1)).alias("n"))
    return flatten_window(res)


def combine_tagged(first: DataFrame, second: DataFrame, first_cols: Sequence[Column],
                   second_cols: Sequence[Column], *, tags: Sequence[str] = STREAM_TAGS) -> DataFrame:
    """Merge two differently shaped frames onto one shape, tagging the origin.

    Each side is mapped by its own column list (same names, compatible
    types), then appended — UNION ALL, duplicates kept.  Works on streams.
    """
    a = first.select(F.lit(tags[0]).alias("stream_tag"), *first_cols)
    b = second.select(F.lit(tags[1]).alias("stream_tag"), *second_cols)
    return a.unionByName(b)


def split_and_combine(df: DataFrame, predicate: Column, key: str, *,
                      tags: Sequence[str] = STREAM_TAGS) -> DataFrame:
    """Split by ``predicate`` then recombine with origin tags:
    ``(stream_tag, key, n=1)`` per input row.

    Splitting and re-merging the same parent is a single projection, so the
    input is read once and nothing is shuffled.
    """
    return df.select(branch(predicate, tags).alias("stream_tag"), F.col(key),
                     F.lit(1).alias("n"))
