"""The exact record-driven watermark against a record-by-record fold."""

import random

import pytest
from pyspark.sql import functions as F

from trailmix.operators.watermark import exact_watermark, refresh_points, split_late_exact


def fold(rows, refresh, buffer):
    """{id: watermark base - buffer before the record, or None}."""
    c, out = None, {}
    for a, seq in sorted(r for r in rows if r[0] is not None):
        out[seq] = None if c is None else c - buffer
        if c is None or a - c > refresh:
            c = a
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "us long, seq long")
    return df.withColumn("arrival", F.timestamp_micros("us")).repartition(3)


def marks(df):
    return {r.seq: r.w for r in df.select("seq", F.unix_micros("watermark").alias("w")).collect()}


@pytest.mark.parametrize("bucket,group", [("1 hour", 64), ("7 seconds", 3), ("1 second", 2), ("25 seconds", 1)])
def test_equals_the_fold(spark, bucket, group):
    rng = random.Random(bucket)
    for span, n in ((400, 300), (400, 12), (5, 200)):
        base = 1_600_000_000_000_000
        rows = [(base + rng.choice([rng.randrange(span * 1_000_000), rng.randrange(span) * 1_000_000]), i) for i in range(n)]
        # Bursts at one arrival, a long silence, and gaps of exactly the refresh.
        rows += [(base + 17_000_000, n + i) for i in range(40)] + [(base + 9_000_000_000, n + 40)]
        rows += [(base + 9_000_000_000 + k * 10_000_000, n + 40 + k) for k in range(1, 6)]
        df = frame(spark, rows)
        got = marks(exact_watermark(df, "arrival", "seq", "10 seconds", "2 seconds", bucket=bucket, group=group))
        assert got == fold(rows, 10_000_000, 2_000_000)


def test_nulls_empty_and_times_before_the_epoch(spark):
    rows = [(None, 1), (-5_000_000, 2), (-20_000_000, 3), (7_000_000, 4), (None, 5)]
    got = marks(exact_watermark(frame(spark, rows), "arrival", "seq", "10 seconds", "2 seconds", bucket="1 second"))
    assert got == {**fold(rows, 10_000_000, 2_000_000), 1: None, 5: None}
    none = frame(spark, rows).limit(0)
    assert exact_watermark(none, "arrival", "seq", "10 seconds", "2 seconds").count() == 0


def test_late_rows_and_points(spark):
    rng = random.Random(4)
    rows = [(10**15 + rng.randrange(300) * 1_000_000, i) for i in range(500)]
    df = frame(spark, rows).withColumn("et", F.timestamp_micros(F.col("us") - F.col("seq") % 30 * 1_000_000))
    mark = fold(rows, 10_000_000, 2_000_000)
    late = {i for a, i in rows if mark[i] is not None and (lambda t: t - t % 1_000_000 + 999_000)(a - i % 30 * 1_000_000) <= mark[i]}
    on_time, gone = split_late_exact(df, "et", "arrival", "seq", "1 second", "10 seconds", "2 seconds")
    assert {r.seq for r in gone.collect()} == late and 0 < len(late) < 500
    assert {r.seq for r in on_time.collect()} == set(range(500)) - late
    chain = sorted(r.point for r in refresh_points(df, "arrival", "seq", "10 seconds").collect())
    assert chain[0] == min(a for a, _ in rows) and all(b - a > 10_000_000 for a, b in zip(chain, chain[1:]))


def test_steps_do_not_grow_with_the_rows(spark):
    """However many rows share them, a bucket sends one step per distinct
    arrival in its first refresh at most."""
    df = spark.range(200_000).select(F.timestamp_micros(F.col("id") % 3600 * 1_000_000).alias("arrival"), F.col("id").alias("seq"))
    plan = exact_watermark(df, "arrival", "seq", "10 seconds", "2 seconds")
    assert plan.count() == 200_000
    from trailmix.operators import watermark as W
    import numpy as np
    import pyarrow as pa
    t = pa.table({"a": np.arange(3600) * 1_000_000, "b": np.zeros(3600, np.int64), "g": np.zeros(3600, np.int64)})
    assert len(W._function(3_600_000_000, 10_000_000)(t).column("at")[0]) <= 12
