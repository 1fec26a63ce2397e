"""Sliding windows from panes: equal to windows that copy each row."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trailmix.operators import windows
from trailmix.operators.panes import sliding_agg
from trailmix.streaming import sinks
from trailmix.streaming.stream import run_to_end

AGGS = {"n": ("*", "count"), "given": ("v", "count"), "total": ("v", "sum"), "least": ("v", "min"), "most": ("v", "max")}


def brute(rows, size, slide, by_key=True):
    """Each row into each of its windows (seconds)."""
    held = {}
    for k, t, v in rows:
        if t is None:
            continue
        w = t - t % slide
        while w > t - size:
            held.setdefault((k if by_key else None, w), []).append(v)
            w -= slide
    out = set()
    for (k, w), vs in held.items():
        some = [v for v in vs if v is not None]
        out.add((k, w, w + size, len(vs), len(some), sum(some) if some else None, min(some, default=None), max(some, default=None)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, sec long, v long").withColumn("ts", F.timestamp_seconds("sec"))


def found(df, keys):
    at = [F.unix_seconds("window_start"), F.unix_seconds("window_end")]
    return [tuple(r) for r in df.select(*([*keys] or [F.lit(None)]), *at, *AGGS).collect()]


@pytest.mark.parametrize("size,slide", [(10, 5), (60, 1), (10, 4), (7, 7), (9, 6), (12, 5)])
def test_equal_to_copied_rows(spark, size, slide):
    rng = random.Random(size * 100 + slide)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([rng.randrange(-150, 150), rng.randrange(5000), None, 40]),
             rng.choice([None, rng.randrange(-9, 9)])) for _ in range(400)]
    df = frame(spark, rows)
    for keys in (["k"], []):
        got = found(sliding_agg(df, "ts", f"{size} seconds", f"{slide} seconds", AGGS, keys=keys), keys)
        assert len(got) == len(set(got)) and set(got) == brute(rows, size, slide, bool(keys))


def test_sparse_and_empty(spark):
    rows = [("u", 0, 1), ("u", 59, None), ("u", 60, 3), ("u", 10**9, 4), ("w", 61, 5)]
    got = found(sliding_agg(frame(spark, rows), "ts", "1 minute", "1 second", AGGS, keys=["k"]), ["k"])
    assert set(got) == brute(rows, 60, 1) and len(got) == len(set(got))
    assert found(sliding_agg(frame(spark, []), "ts", "1 minute", "1 second", AGGS), []) == []


def test_time_kinds_and_clashing_names(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 7))], "n int, t timestamp_ntz")
    out = sliding_agg(df, "t", "10 seconds", "5 seconds", {"m": ("n", "sum")}, keys=["n"])
    assert sorted(map(tuple, out.collect())) == [(dt.datetime(2024, 1, 1, 0, 0, s), dt.datetime(2024, 1, 1, 0, 0, s + 10), 1, 1) for s in (0, 5)]
    ms = sliding_agg(spark.range(12000, 12001), "id", "10 seconds", "10 seconds", {"m": ("*", "count")})
    assert ms.collect() == [(10000, 20000, 1)]


def test_refuses(spark):
    df = frame(spark, [])
    with pytest.raises(ValueError):
        sliding_agg(df, "ts", "1 second", "2 seconds", AGGS)
    with pytest.raises(ValueError):
        sliding_agg(df, "ts", "2 seconds", "1 second", {"x": ("v", "median")})


def test_no_row_is_copied_before_the_exchange(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plans = [windows.window_summary(ev, "ts", "60 hours", slide=s)._jdf.queryExecution().executedPlan().toString()
             for s in ("1 hour", "30 hours")]
    for p in plans:
        scans = re.split(r"FileScan", p)[:-1]
        below = [s[s.rindex("Exchange"):] for s in scans]
        assert below and all("Expand" not in b and "Generate" not in b and "partial_min" in b for b in below)


def test_stream_in_two_aggregations(spark, scratch):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "a"]), rng.randrange(100), rng.randrange(9)) for _ in range(300)]
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    frame(spark, [*rows, ("end", 10**6, 0)]).select("k", "sec", "v").write.csv(src)
    df = spark.readStream.schema("k string, sec long, v long").csv(src).withColumn("ts", F.timestamp_seconds("sec")).withWatermark("ts", "1 second")
    res = sliding_agg(df, "ts", "10 seconds", "2 seconds", AGGS, keys=["k"])
    run_to_end(sinks.write_parquet(res, out, "panes", trigger={"availableNow": True}, checkpoint=os.path.join(scratch, "ck")))
    assert {r for r in found(spark.read.parquet(out), ["k"]) if r[0] != "end"} == brute(rows, 10, 2)
