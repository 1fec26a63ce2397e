"""Ordered per-key scans that survive a hot key.

The reference folds each user's records one by one (keyed state at
parallelism 1).  The batch equivalent is a window function partitioned by
user, but a plain ``Window.partitionBy(user)`` sends all rows of one user to
one task; if one user holds a third of the data, that task holds a third of
the data.

Every scan here runs in two phases over ``(key, time bucket)``:

1. rows are hash-partitioned by ``(key, bucket)`` and the scan runs inside
   each bucket with an ordinary window function — a hot key is spread over
   as many tasks as it has buckets;
2. one summary row per ``(key, bucket)`` (its total, maximum or last row) is
   scanned per key across buckets — that table has (#keys x #buckets) rows,
   independent of the rows per bucket — and joined back on
   ``(key, bucket)``.  The big side is already partitioned on the join key,
   so only the summary side moves; AQE turns the join into a broadcast when
   the summary's measured size is below the broadcast threshold.

The bucket is taken from the leading order column (a time, or a numeric
arrival sequence) and its width is a parameter: pick it so that the
hottest key's rows in one bucket fit one task.  The scans are exact for any
width because the bucket is a monotone function of the leading order column.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmix.functions.time import duration_micros, epoch_micros
from trailmix.session import ensure_checkpoint_dir

BUCKET = "__bucket"
SUB = "__sub"
TIE = "__tie"
DEFAULT_BUCKET = "1 day"
# A (key, bucket) with more rows than this is cut into slices (None turns the
# check off).  There are at most rows / DEFAULT_MAX_ROWS such groups.
DEFAULT_MAX_ROWS = 5_000_000
# Quantiles at which a hot group is cut.
SLICES = 256
# Up to this many hot groups (a few KB each at most) their list is broadcast.
MAX_BROADCAST_GROUPS = 10_000


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _bucket_value(df: DataFrame, col: str, bucket: str | int) -> tuple[Column, int]:
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(df, col), duration_micros(bucket)
    if isinstance(dtype, (T.IntegralType, T.FractionalType)) and isinstance(bucket, int):
        return F.col(col), bucket
    raise TypeError(f"cannot bucket {col} ({dtype}) by {bucket!r}")


def with_bucket(df: DataFrame, col: str, bucket: str | int) -> DataFrame:
    """Add ``__bucket`` = floor(col / width); times in microseconds, numbers as is."""
    value, width = _bucket_value(df, col, bucket)
    return df.withColumn(BUCKET, F.floor(value / F.lit(width)).cast("long"))


def hot_slices(df: DataFrame, keys: list[str], order: Sequence[str], bucket: str | int,
               max_rows: int) -> DataFrame | None:
    """Where to cut the (key, bucket) groups of more than ``max_rows`` rows:
    ``(*keys, __bucket, __cuts, __ties)``, or None where there is no such group.

    ``__cuts`` are the ``SLICES``-quantiles of the group's leading order
    column.  Rows between two cuts make a slice and rows *at* a cut make one of
    their own, so an instant with a large share of the rows is set apart; such
    a slice, where it still has too many rows, is cut again at the quantiles of
    the next order column (``__ties``: slice -> cuts).  A slice therefore holds
    at most about ``rows / SLICES`` rows, whatever their spread over time.

    One counting pass over the key and order columns finds the hot groups, a
    second one over the hot groups only (if any) takes their quantiles, from
    sketches that combine map-side.  The result is written once under the
    checkpoint folder; pass it to further scans over the same input
    (``hot=``), which then count nothing.
    """
    base = with_bucket(df, order[0], bucket)
    value, _ = _bucket_value(df, order[0], bucket)
    group = [*keys, BUCKET]
    counts = base.groupBy(*group).agg(F.count(F.lit(1)).alias("__cnt")).filter(F.col("__cnt") > max_rows)
    hot = _kept(counts)
    if hot.isEmpty():
        return None
    rows = _semi(base.withColumn("__bv", value), hot, group)
    points = [i / SLICES for i in range(1, SLICES)]
    cuts = rows.groupBy(*group).agg(F.array_sort(F.array_distinct(F.percentile_approx("__bv", points, F.lit(10 * SLICES)))).alias("__cuts"))
    if len(order) < 2 or not isinstance(df.schema[order[1]].dataType, T.IntegralType):
        return _kept(cuts.withColumn("__ties", F.lit(None).cast("map<bigint,array<bigint>>")))
    cuts = _kept(cuts)
    sliced = _join_back(rows, cuts, keys, [BUCKET]).withColumn(SUB, _slice(F.col("__bv"), F.col("__cuts")))
    ties = (sliced.groupBy(*group, SUB).agg(F.count(F.lit(1)).alias("__cnt"),
                                            F.array_sort(F.array_distinct(F.percentile_approx(order[1], points, F.lit(10 * SLICES)))).alias("__tie"))
            .filter(F.col("__cnt") > max_rows).groupBy(*group)
            .agg(F.map_from_entries(F.collect_list(F.struct(SUB, F.col("__tie").cast("array<bigint>")))).alias("__ties")))  # <= 2 * SLICES entries
    return _kept(_join_back(cuts, ties, keys, [BUCKET]))


def _kept(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _semi(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    s = small.select(*[F.col(k).alias(f"__s_{k}") for k in on])
    cond = [big[k].eqNullSafe(s[f"__s_{k}"]) for k in on]
    return big.join(s, cond, "left_semi")


def _slice(value: Column, cuts: Column) -> Column:
    """Slice number of a value among sorted cuts: even between, odd at a cut."""
    below = F.size(F.filter(cuts, lambda c: c < value))
    return (2 * below + F.coalesce(F.array_contains(cuts, value), F.lit(False)).cast("int")).cast("long")


def bucketed(df: DataFrame, keys: list[str], order: str | Sequence[str], bucket: str | int,
             max_rows: int | None = None, hot: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Bucket columns for the two-phase scans: ``[__bucket]``, and where a
    (key, bucket) group holds more than ``max_rows`` rows also its slice and
    tie slice (``hot_slices``, or those given as ``hot``).  Slices ascend with
    ``order`` inside a bucket, so every scan stays exact; the limit changes the
    plan only.
    """
    order = [order] if isinstance(order, str) else list(order)
    base = with_bucket(df, order[0], bucket)
    if hot is None and max_rows is not None:
        hot = hot_slices(df, keys, order, bucket, max_rows)
    if hot is None:
        return base, [BUCKET]
    value, _ = _bucket_value(df, order[0], bucket)
    # The list is broadcast only while its measured length is small.
    small = F.broadcast(hot) if hot.count() <= MAX_BROADCAST_GROUPS else hot
    marked = _join_back(base, small, keys, [BUCKET])
    marked = marked.withColumn(SUB, F.when(F.col("__cuts").isNull(), F.lit(0).cast("long")).otherwise(_slice(value.cast("long"), F.col("__cuts"))))
    bcols = [BUCKET, SUB]
    if len(order) > 1 and isinstance(df.schema[order[1]].dataType, T.IntegralType):
        tie = F.element_at("__ties", F.col(SUB))
        marked = marked.withColumn(TIE, F.when(tie.isNull(), F.lit(0).cast("long")).otherwise(_slice(F.col(order[1]).cast("long"), tie)))
        bcols.append(TIE)
    return marked.drop("__cuts", "__ties"), bcols


_SHIFT = Decimal(10 ** 20)          # > 2^64: room for any BIGINT tie-breaker
_LONG_OFFSET = Decimal(2 ** 63)     # BIGINT -> non-negative


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """One fixed-width value ordered like the tuple ``order``.

    ``min_by``/``max_by`` over a struct fall back to sort-based aggregation
    (every partition sorted before aggregating).  A (timestamp, integer)
    order is packed exactly into one DECIMAL(38,0) — timestamps span years
    1..9999, i.e. |micros| < 2.6e17, so micros * 1e20 + (id + 2^63) < 1e38 —
    and the aggregation stays hash-based.  Other shapes keep the struct.
    """
    if len(order) == 1:
        return F.col(order[0])
    types = [df.schema[c].dataType for c in order]
    if (len(order) == 2 and isinstance(types[0], (T.TimestampType, T.TimestampNTZType))
            and isinstance(types[1], (T.LongType, T.IntegerType, T.ShortType))):
        dec = T.DecimalType(38, 0)
        return (epoch_micros(df, order[0]).cast(dec) * F.lit(_SHIFT).cast(dec)
                + (F.col(order[1]).cast(dec) + F.lit(_LONG_OFFSET).cast(dec)))
    return F.struct(*order)


def _join_back(big: DataFrame, small: DataFrame, keys: list[str],
               bcols: Sequence[str] = (BUCKET,), *, null_safe: bool = True) -> DataFrame:
    """Left join on (keys, bucket columns), null-safe on the keys unless
    ``null_safe=False`` (keys from ``_plain_keys``, never null)."""
    on = keys + list(bcols)
    s = small.select(*[F.col(k).alias(f"__s_{k}") for k in on],
                     *[c for c in small.columns if c not in on])
    if null_safe:
        cond = [big[k].eqNullSafe(s[f"__s_{k}"]) for k in on]
    else:
        cond = [big[k] == s[f"__s_{k}"] for k in on]
    out = big.join(s, cond, "left")
    return out.drop(*[f"__s_{k}" for k in on])


def _plain_keys(df: DataFrame, keys: list[str], keep: Sequence[str]
                ) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """Replace each nullable numeric or string key ``k`` by two never-null
    stand-ins, ``(coalesce(k, 0 or ''), isnull(k))``; return the frame, the
    stand-in key names and the expressions that restore the keys.

    Windows partition by the stand-ins and the join back matches them with
    plain equality, so the join keys are the window's own hash partitioning
    and the full-row side is not shuffled again (a null-safe join hashes
    ``coalesce``/``isnull`` expressions, which no earlier exchange produced).
    The key itself is dropped so both branches of a scan carry the same
    columns and AQE reuses the one exchange.  Returns no stand-ins when a key
    has another type or is also an order or value column (``keep``).
    """
    out, restore, cols = [], {}, {}
    for k in keys:
        f = df.schema[k]
        if not f.nullable:
            out.append(k)
        elif isinstance(f.dataType, (T.NumericType, T.StringType)) and k not in keep:
            default = F.lit("") if isinstance(f.dataType, T.StringType) else F.lit(0)
            kv, kn = f"__kv_{k}", f"__kn_{k}"
            cols[kv] = F.coalesce(F.col(k), default.cast(f.dataType))
            cols[kn] = F.col(k).isNull()
            restore[k] = F.when(F.col(kn), F.lit(None).cast(f.dataType)).otherwise(F.col(kv))
            out += [kv, kn]
        else:
            return df, [], {}
    if not restore:
        return df, out, {}
    return df.withColumns(cols).drop(*restore), out, restore


def _scan_keys(df: DataFrame, keys: list[str], keep: Sequence[str]
               ) -> tuple[DataFrame, list[str], bool, dict[str, Column]]:
    """Keys for a two-phase scan: never-null stand-ins when every key allows
    them (then the join back is a plain equi-join), else the keys as given."""
    df2, plain, restore = _plain_keys(df, keys, keep)
    return (df2, plain, True, restore) if plain else (df, keys, False, {})


def _restored(cols: Sequence[str], restore: dict[str, Column]) -> list[Column]:
    return [restore[c].alias(c) if c in restore else F.col(c) for c in cols]


def running_agg(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                value: Column | str, out: str, *, agg: str = "sum", inclusive: bool = True,
                bucket: str | int = DEFAULT_BUCKET, max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                hot: DataFrame | None = None) -> DataFrame:
    """Running ``sum``, ``max`` or ``last`` (last non-null) of ``value`` per
    key in ``order``; ``order`` must be unique within a key.

    ``inclusive=False`` excludes the current row (the value *before* it).
    Buckets are cut on ``order[0]`` (see ``bucketed`` for ``max_rows_per_bucket``).
    """
    cols = df.columns
    keep = [*order, *([value] if isinstance(value, str) else [])]
    names = _names(keys)
    if hot is None and max_rows_per_bucket is not None:
        hot = hot_slices(df, names, order, bucket, max_rows_per_bucket)
    base, bc = bucketed(df, names, order, bucket, hot=hot)
    base, keys, plain, restore = _scan_keys(base, names, keep)
    if isinstance(value, str):
        v = value  # no alias: both branches then need the same columns
    else:
        base, v = base.withColumn("__v", value), "__v"
    upper = Window.currentRow if inclusive else -1
    w = (Window.partitionBy(*keys, *bc).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, upper))
    wb = Window.partitionBy(*keys).orderBy(*bc).rowsBetween(Window.unboundedPreceding, -1)
    incl = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if agg == "last":
        fn = lambda c: F.last(c, ignorenulls=True)
    else:
        fn = {"sum": F.sum, "max": F.max}[agg]
    ordered = Window.partitionBy(*keys, *bc).orderBy(*order)
    local = base.withColumn("__local", fn(v).over(w))
    local = local.withColumn("__incl", F.col("__local") if inclusive else fn(v).over(incl))
    local = local.withColumn("__last", F.lead(F.lit(1)).over(ordered).isNull())
    # The bucket's summary is the inclusive scan at its last row, taken from
    # the same windowed rows: one scan and one exchange, which AQE reuses.
    totals = local.filter(F.col("__last")).select(*keys, *bc, F.col("__incl").alias("__btot"))
    offsets = totals.select(*keys, *bc, fn("__btot").over(wb).alias("__off"))

    joined = _join_back(local, offsets, keys, bc, null_safe=not plain)
    if agg == "sum":
        res = (F.when(F.col("__local").isNull(), F.col("__off"))
                .when(F.col("__off").isNull(), F.col("__local"))
                .otherwise(F.col("__local") + F.col("__off")))
    elif agg == "max":
        res = F.greatest("__local", "__off")
    else:
        res = F.coalesce("__local", "__off")
    return joined.select(*_restored(cols, restore), res.alias(out))


def previous_in_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                    cols: Sequence[str], *, prefix: str = "prev_",
                    bucket: str | int = DEFAULT_BUCKET,
                    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS,
                    hot: DataFrame | None = None) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key.

    ``order`` must be unique within a key; buckets are cut on ``order[0]``.
    A row with a predecessor in its own bucket is final after the bucket scan.
    Only the first and last row of each bucket (two at most) go on to a scan
    across buckets, in which a first row finds the last row before it: no row
    is joined, and all others are shuffled and sorted once.
    """
    cols = list(cols)
    out_cols = df.columns
    names = _names(keys)
    if hot is None and max_rows_per_bucket is not None:
        hot = hot_slices(df, names, order, bucket, max_rows_per_bucket)
    base, bc = bucketed(df, names, order, bucket, hot=hot)
    w = Window.partitionBy(*names, *bc).orderBy(*order)
    local = base.select(
        "*",
        *[F.lag(c).over(w).alias(f"__l_{c}") for c in cols],
        (F.row_number().over(w) == 1).alias("__first"),
        F.lead(F.lit(1)).over(w).isNull().alias("__last"),
    )
    inside = local.filter(~F.col("__first"))
    across = Window.partitionBy(*names).orderBy(*bc, *order)
    edges = local.filter(F.col("__first") | F.col("__last"))
    firsts = edges.withColumns({f"__l_{c}": F.lag(c).over(across) for c in cols}).filter("__first")
    return inside.unionByName(firsts).select(*out_cols, *[F.col(f"__l_{c}").alias(f"{prefix}{c}") for c in cols])
