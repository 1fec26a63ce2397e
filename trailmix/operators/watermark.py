"""The record-driven watermark, exactly, without a scan by one task.

The watermark base ``c`` starts at the first record's arrival and jumps to the
arrival of each record that comes more than ``refresh`` after it; the watermark
trails it by ``buffer``.  What a record meets is the base that the records
before it left, so every refresh point depends on the one before it:

    next(c) = first arrival later than c + refresh

Arrivals are cut into buckets of time.  To a bucket, all that went before is one
number, the threshold c + refresh, so a bucket is a step function from threshold
to threshold: steps at its own arrivals, no change beyond them.  Only its first
``refresh`` of time can matter (no earlier base reaches further), so it has at
most one step for each distinct arrival in there, however many rows there are.

1. Each bucket's function: pointers from each arrival to the next, doubled until
   they reach the bucket's last refresh point.
2. Functions of ``GROUP`` neighbouring buckets are composed, group by group.
3. One pass over the groups' functions gives each group its threshold (one short
   row of steps per group); each group passes it through its buckets.
4. With its threshold each bucket lists its own refresh points.

Refresh points lie more than ``refresh`` apart, so a record finds its base among
those of its own and the previous stretch of that length: an equality join with
a table of at most two rows for each ``refresh`` of time.

Defined results.  Null arrival: no watermark, never late.  The first record has
no watermark before it.  Records of equal arrival are in the order of ``seq``;
of equal arrival and ``seq``, all count as the first of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.functions.time import duration_micros, epoch_micros, micros_to_time

BUCKET = "1 hour"
GROUP = 64
_NEVER = -(1 << 62)
_STEPS = "g long, b long, at array<long>, to array<long>"


def _bin(us: Column, width: int) -> Column:
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")


def _last_points(a: np.ndarray, refresh: int) -> np.ndarray:
    """The last refresh point that a chain reaches from each of the arrivals."""
    n = len(a)
    nxt = np.searchsorted(a, a + refresh, side="right")
    jump = np.where(nxt < n, nxt, np.arange(n))
    while True:
        further = jump[jump]
        if (further == jump).all():
            return a[jump]
        jump = further


def _steps(at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without steps that change nothing."""
    keep = np.append(to[1:] != to[:-1], True) if len(to) else np.zeros(0, bool)
    return at[keep], to[keep]


def _through(at: np.ndarray, to: np.ndarray, theta):
    """The function's value: of the first step beyond the threshold, else itself."""
    i = np.searchsorted(at, theta, side="right")
    return np.where(i < len(at), to[np.minimum(i, len(at) - 1)], theta) if len(at) else np.asarray(theta)


def _function(width: int, refresh: int):
    def of_bucket(t: pa.Table) -> pa.Table:
        a = np.sort(t.column("a").to_numpy())
        b, g = t.column("b")[0], t.column("g")[0]
        # The thresholds that can come in are below the bucket's start + refresh.
        reach = int(np.searchsorted(a, b.as_py() * width + refresh, side="right")) + 1
        at, to = _steps(a[:reach], (_last_points(a, refresh) + refresh)[:reach])
        return pa.table({"g": [g.as_py()], "b": [b.as_py()], "at": [at], "to": [to]},
                        pa.schema([("g", pa.int64()), ("b", pa.int64()), ("at", pa.list_(pa.int64())), ("to", pa.list_(pa.int64()))]))

    return of_bucket


def _in_order(t: pa.Table, by: str) -> list[dict]:
    return [{**r, "at": np.array(r["at"], np.int64), "to": np.array(r["to"], np.int64)} for r in t.sort_by(by).to_pylist()]


def _composed(t: pa.Table) -> pa.Table:
    """One function of a group's buckets, in order of time."""
    at, to = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for r in _in_order(t, "b"):
        later = r["at"] > (at[-1] if len(at) else _NEVER)
        through = _through(r["at"], r["to"], to)
        at, to = _steps(np.concatenate([at, r["at"][later]]), np.concatenate([through, r["to"][later]]))
    return pa.table({"g": [t.column("g")[0].as_py()], "at": [at], "to": [to]},
                    pa.schema([("g", pa.int64()), ("at", pa.list_(pa.int64())), ("to", pa.list_(pa.int64()))]))


def _thresholds(by: str):
    """The threshold that comes to each row's function, in order; the first is
    given in ``theta`` (null: none yet)."""
    def run(t: pa.Table) -> pa.Table:
        rows = _in_order(t, by)
        theta = rows[0]["theta"] if rows[0].get("theta") is not None else _NEVER
        out = []
        for r in rows:
            out.append(theta)
            theta = int(_through(r["at"], r["to"], theta))
        return pa.table({by: [r[by] for r in rows], "theta": out}, pa.schema([(by, pa.int64()), ("theta", pa.int64())]))

    return run


def _points(refresh: int):
    def of_bucket(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("a").to_numpy())
        a = t.column("a").to_numpy()[order]
        theta = t.column("theta")[0].as_py()
        at, i = [], int(np.searchsorted(a, theta, side="right"))
        while i < len(a):
            at.append(i)
            i = int(np.searchsorted(a, a[i] + refresh, side="right"))
        points = a[at]
        before = np.concatenate([[theta - refresh], points[:-1]])[:len(points)]
        first = np.array(t.column("first_seq").to_pylist(), object)[order][at]
        prev = pa.array(before, mask=before < _NEVER // 2) if len(points) else pa.array([], pa.int64())
        return pa.table({"point": pa.array(points, pa.int64()), "prev": prev, "first_seq": pa.array(list(first), t.schema.field("first_seq").type)})

    return of_bucket


def refresh_points(df: DataFrame, arrival_col: str, seq_col: str, refresh: str | int, bucket: str = BUCKET,
                   group: int = GROUP) -> DataFrame:
    """(point, prev, first_seq): the arrivals (microseconds) to which the base
    jumps, the base before, and the least ``seq`` of that arrival."""
    r, width = duration_micros(refresh), duration_micros(bucket)
    a = epoch_micros(df, arrival_col)
    arrivals = (df.select(a.alias("a"), F.col(seq_col).alias("seq")).filter(F.col("a").isNotNull())
                .groupBy("a").agg(F.min("seq").alias("first_seq")))
    b = _bin(F.col("a"), width)
    arrivals = arrivals.withColumns({"b": b, "g": _bin(b, group)})
    functions = arrivals.select("a", "b", "g").groupBy("b").applyInArrow(_function(width, r), _STEPS)
    groups = functions.groupBy("g").applyInArrow(_composed, "g long, at array<long>, to array<long>")
    first = groups.withColumn("every", F.lit(0)).groupBy("every").applyInArrow(_thresholds("g"), "g long, theta long")
    within = functions.join(first, "g").groupBy("g").applyInArrow(_thresholds("b"), "b long, theta long")
    seq = dict(df.dtypes)[seq_col]
    return (arrivals.join(within, "b").select("a", "b", "first_seq", "theta").groupBy("b")
            .applyInArrow(_points(r), f"point long, prev long, first_seq {seq}"))


def exact_watermark(df: DataFrame, arrival_col: str, seq_col: str, refresh: str | int, buffer: str | int, *,
                    out: str = "watermark", bucket: str = BUCKET, group: int = GROUP) -> DataFrame:
    """``df`` with the watermark in force when each record arrives (of the
    arrival column's type; null for the first record)."""
    r = duration_micros(refresh)
    points = refresh_points(df, arrival_col, seq_col, refresh, bucket, group)
    none = F.lit(None)
    own = points.select(_bin(F.col("point"), r).alias("__bin"), F.col("point").alias("__own"), F.col("prev").alias("__prev"),
                        F.col("first_seq").alias("__first"), none.cast("long").alias("__carry"))
    carry = points.select((_bin(F.col("point"), r) + 1).alias("__bin"), none.cast("long"), none.cast("long"),
                          none.cast(dict(points.dtypes)["first_seq"]), F.col("point"))
    bins = own.union(carry).groupBy("__bin").agg(*[F.max(c).alias(c) for c in ("__own", "__prev", "__first", "__carry")])
    rows = df.withColumn("__a", epoch_micros(df, arrival_col))
    rows = rows.withColumn("__bin", _bin(F.col("__a"), r)).join(bins, "__bin", "left")
    a, point = F.col("__a"), F.col("__own")
    after = F.when(point <= a, point).when(point.isNotNull(), F.col("__prev")).otherwise(F.col("__carry"))
    base = F.when((point == a) & F.col(seq_col).eqNullSafe(F.col("__first")), F.col("__prev")).otherwise(after)
    mark = micros_to_time(base - F.lit(duration_micros(buffer)), df.schema[arrival_col].dataType)
    return rows.select(*df.columns, mark.alias(out))


def split_late_exact(df: DataFrame, time_col: str, arrival_col: str, seq_col: str, size: str, refresh: str | int,
                     buffer: str | int, *, bucket: str = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(on_time, late) under that watermark: a record is late if its tumbling
    window of ``size`` had closed when it arrived.  Batch frames; a stream takes
    ``operators.late.split_late``."""
    marked = exact_watermark(df, arrival_col, seq_col, refresh, buffer, out="__mark", bucket=bucket)
    w = F.lit(duration_micros(size))
    t = epoch_micros(df, time_col)
    closed = t - F.pmod(t, w) + w - F.lit(1000) <= epoch_micros(marked, "__mark")
    flagged = marked.withColumn("__late", F.coalesce(closed, F.lit(False)))
    return (flagged.filter(~F.col("__late")).select(*df.columns), flagged.filter(F.col("__late")).select(*df.columns))
