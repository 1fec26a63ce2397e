"""A user's reduce per key and event-time window of a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from trailmix.streaming import sinks
from trailmix.streaming.reduce import window_reduce_stream
from trailmix.streaming.stream import run_to_end

ONCE = {"availableNow": True}
SCHEMA = "user string, sec long, v long"


def odd_most(a, b):
    """Associative, and no built-in aggregate: the value whose last three digits are greatest."""
    return max(a, b, key=lambda x: (x % 1000, x))


def write(src, name, rows, at):
    os.makedirs(src, exist_ok=True)
    p = os.path.join(src, f".{name}.tmp")
    with open(p, "w") as f:
        f.writelines(",".join("" if x is None else str(x) for x in r) + "\n" for r in rows)
    os.utime(p, (at, at))
    os.rename(p, os.path.join(src, f"{name}.csv"))


def run(spark, src, out, ck):
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).csv(src).withColumn("ts", F.timestamp_seconds("sec"))
    res = window_reduce_stream(df.repartition(3), ["user"], "ts", "10 seconds", "5 seconds", "v", odd_most)
    q = sinks.write_parquet(res, out, f"reduce_{os.path.basename(ck)}", trigger=ONCE, checkpoint=ck)
    run_to_end(q)
    return q


def expected(batches, delay=5, size=10):
    """Record by record; the watermark moves between micro-batches."""
    open_, done, mark = {}, {}, 0
    for rows in [*batches, []]:
        for u, t, v in rows:
            w = (u, t - t % size) if t is not None else None
            if w is not None and v is not None and w[1] + size > mark:
                n, acc = open_.get(w, (0, None))
                open_[w] = (n + 1, v if acc is None else odd_most(acc, v))
        mark = max([mark, *[t - delay for _, t, _ in rows if t is not None]])
        for w in [w for w in open_ if w[1] + size <= mark]:
            assert w not in done
            done[w] = open_.pop(w)
    return {(u, s, s + size, *x) for (u, s), x in done.items()}


def found(spark, out):
    rows = spark.read.parquet(out).select("user", F.unix_seconds("window_start"), F.unix_seconds("window_end"), "n", "reduced").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_windows_late_rows_and_restart(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    rng = random.Random(3)
    batches = []
    for b in range(4):
        rows = [(rng.choice(["hot"] * 8 + ["a", None]), b * 20 + rng.randrange(25), rng.randrange(10**6)) for _ in range(300)]
        rows += [("hot", None, 1), ("hot", b * 20, None), ("late", 3, 999), ("hot", b * 20 + 24, 7)]
        batches.append(rows)
    for i, rows in enumerate(batches[:2]):
        write(src, f"b{i}", rows, 1000 + i)
    run(spark, src, out, ck)
    for i, rows in enumerate(batches[2:], 2):
        write(src, f"b{i}", rows, 1000 + i)
    end = [("end", 10**6, 1)]
    write(src, "end", end, 2000)
    q = run(spark, src, out, ck)
    want = expected([*batches, end])
    assert any(u is None for u, *_ in want) and sum(n for u, *_, n, _ in want if u == "late") < 4
    assert found(spark, out) == want
    # A key's state saw one row per task and window, not its records.
    seen = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"] > 100]
    assert seen and all(s["numRowsUpdated"] < 60 for s in seen)


def test_refuses(spark, scratch):
    df = spark.readStream.schema("user string, ts timestamp, v array<int>").json(scratch)
    with pytest.raises(TypeError):
        window_reduce_stream(df, ["user"], "ts", "1 second", "1 second", "v", max)
    with pytest.raises(ValueError):
        window_reduce_stream(df.withColumn("v", F.lit(1)), ["user"], "ts", "5 microseconds", "1 second", "v", max)
