"""Processing-time windows that close by the clock, user state, split folds."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from trailmix.streaming import prefix as PX
from trailmix.streaming import processors as P
from trailmix.streaming import sinks
from trailmix.streaming.clock import clock_window_agg
from trailmix.streaming.prefix import Last, Sum
from trailmix.streaming.stateful import KeyedFunction, apply_keyed
from trailmix.streaming.stream import run_to_end

ONCE = {"availableNow": True}
SCHEMA = "id long, user string, sec long, op string, v long"


def _write(folder, name, rows, at=None):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, f".{name}.tmp")
    with open(p, "w") as f:
        f.writelines(",".join("" if x is None else str(x) for x in r) + "\n" for r in rows)
    if at is not None:
        os.utime(p, (at, at))
    os.rename(p, os.path.join(folder, f"{name}.csv"))


def _read(spark, folder, per_trigger=None):
    reader = spark.readStream.schema(SCHEMA)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.csv(folder).withColumn("ts", F.timestamp_seconds("sec"))


def _wait(check, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if (found := check()) is not None:
            return found
        time.sleep(0.3)
    raise AssertionError("nothing came in time")


def test_windows_close_in_silence_and_after_a_restart(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    aggs = {"n": ("*", "count"), "given": ("v", "count"), "total": ("v", "sum"), "least": ("v", "min"), "most": ("v", "max")}

    def start():
        df = clock_window_agg(_read(spark, src), "3 seconds", aggs, keys=["user"])
        return sinks.write_parquet(df, out, "clocked", trigger={"processingTime": "500 milliseconds"}, checkpoint=os.path.join(scratch, "ck"))

    def found():
        try:
            rows = spark.read.parquet(out).collect()
        except Exception:
            return None
        return rows or None

    q = start()
    try:
        _write(src, "a", [(i, "hot" if i % 10 else None, 0, "x", i if i % 4 else None) for i in range(200)])
        rows = _wait(lambda: (r := found()) and (r if sum(x.n for x in r) == 200 else None))
        assert q.isActive and all((r.window_end - r.window_start).total_seconds() == 3 for r in rows)
        assert sum(r.n for r in rows if r.user is None) == 20 and len(rows) == 2
        hot = next(r for r in rows if r.user == "hot")
        values = [i for i in range(200) if i % 10 and i % 4]
        assert (hot.n, hot.given, hot.total, hot.least, hot.most) == (180, len(values), sum(values), min(values), max(values))
        # Rows come, and the query is stopped before their window ends.
        before = len(q.recentProgress)
        _write(src, "b", [(i, "late", 0, "x", 1) for i in range(5)])
        _wait(lambda: True if any(p["numInputRows"] == 5 for p in q.recentProgress[before - 1:]) else None)
    finally:
        q.stop()
    q = start()
    try:
        rows = _wait(lambda: (r := found()) and ([x for x in r if x.user == "late"] or None))
        time.sleep(3)
        rows = [x for x in found() if x.user == "late"]
        assert [r.n for r in rows] == [5]
    finally:
        q.stop()
    assert q.exception() is None


def test_window_over_all_keys_gets_one_row_per_task(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    df = clock_window_agg(_read(spark, src).repartition(3), "1 second", {"n": ("*", "count"), "first": ("sec", "min")})
    assert df.columns == ["window_start", "window_end", "n", "first"]
    q = sinks.write_parquet(df, out, "clock_all", trigger={"processingTime": "300 milliseconds"}, checkpoint=os.path.join(scratch, "ck"))
    try:
        _write(src, "a", [(i, "u", 50 + i, "x", i) for i in range(3000)])

        def done():
            try:
                rows = spark.read.parquet(out).collect()
            except Exception:
                return None
            return rows if rows and sum(r.n for r in rows) == 3000 else None
        rows = _wait(done)
        assert min(r["first"] for r in rows) == 50
        # The state operator saw partial rows, not records.
        seen = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]]
        assert seen and max(seen) <= 3
    finally:
        q.stop()


def test_clock_windows_refuse_what_does_not_combine(spark):
    df = spark.createDataFrame([("a", "b")], "user string, v string")
    with pytest.raises(TypeError):
        clock_window_agg(df, "1 second", {"x": ("v", "max")})
    with pytest.raises(ValueError):
        clock_window_agg(df, "1 second", {"x": ("v", "median")})


# ------------------------------------------------------------- user state

class Repeats(KeyedFunction):
    states = {"last": "t BIGINT"}
    output = "t BIGINT, seq BIGINT, gap_us BIGINT"

    def process(self, key, row, state):
        if row.op == "error":
            if state.last.exists() and row.t - state.last.get()[0] < 10_000_000:
                yield row.t, row.seq, row.t - state.last.get()[0]
            state.last.update((row.t,))

    def start(self, key, row, state):
        state.last.update((row.t,))


class Durations(KeyedFunction):
    states = {"open": "action STRING, t BIGINT"}
    output = "t BIGINT, seq BIGINT, last_action STRING, duration_us BIGINT"

    def process(self, key, row, state):
        held = state.open.get()
        known = held is not None and row.action != "in"
        yield row.t, row.seq, held[0] if known else "None", row.t - held[1] if known else 0
        if row.action == "out":
            state.open.clear()
        else:
            state.open.update((row.action, row.t))


def _records(seed, n=400):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 9 + ["a", "b", ""]), 1000 + i * 3 + rng.randrange(-9, 9), rng.choice(["error", "view", "in", "out"]),
             rng.choice([None, 1, 5, -3])) for i in range(n)]


def _parts(folder, rows, n):
    now, per = time.time() - 1000, -(-len(rows) // n)
    for i in range(n):
        _write(folder, f"p{i}", rows[i * per:(i + 1) * per], now + i)


def _drain(spark, df, name, scratch, trigger=ONCE, ck=None):
    out = os.path.join(scratch, f"out_{name}")
    run_to_end(sinks.write_parquet(df, out, name, trigger=trigger, checkpoint=ck or os.path.join(scratch, f"ck_{name}")), timeout_s=300)
    return sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)


def test_user_code_gives_the_rows_of_the_fixed_folds(spark, scratch):
    src = os.path.join(scratch, "in")
    rows = _records(1)
    _parts(src, rows[:300], 3)
    stream = _read(spark, src, 1)
    ops = P.keyed_input(stream, ["user"], "ts", "id", {"op": "op"}, order="id")
    acts = P.keyed_input(stream, ["user"], "ts", "id", {"action": "op"}, order="id")

    def user(part):
        return (_drain(spark, apply_keyed(ops, ["user"], Repeats(), ["ord", "seq"]), "user_r", scratch),
                _drain(spark, apply_keyed(acts, ["user"], Durations(), ["ord", "seq"]), "user_d", scratch))

    def fixed(part):
        r = P.repeat_alert_stream(ops, ["user"], "error", "10 seconds").select("user", "t", "seq", "interval_us")
        d = P.action_duration_stream(acts, ["user"], login="in", logout="out")
        return _drain(spark, r, "fixed_r", scratch), _drain(spark, d, "fixed_d", scratch)

    got = user(1)
    assert got == fixed(1) and len(got[0]) > 5 and len(got[1]) == 300
    # More files and a restart from the checkpoint: states go on.
    _parts(os.path.join(scratch, "more"), rows[300:], 1)
    os.rename(os.path.join(scratch, "more", "p0.csv"), os.path.join(src, "p9.csv"))
    got = user(2)
    assert got == fixed(2) and len(got[1]) == 400
    # The same code on a batch frame.
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("sec"))
    again = apply_keyed(P.keyed_input(batch, ["user"], "ts", "id", {"action": "op"}, order="id"), ["user"], Durations(), ["ord", "seq"])
    assert sorted(map(tuple, again.withColumn("user", F.coalesce("user", F.lit(""))).collect()), key=repr) == \
        sorted([(r[0] or "", *r[1:]) for r in got[1]], key=repr)


def test_initial_state_comes_from_a_table(spark, scratch):
    src = os.path.join(scratch, "in")
    _parts(src, [(1, "a", 100, "error", 0), (2, "b", 100, "error", 0)], 1)
    before = spark.createDataFrame([("a", 95_000_000), ("c", 1)], "user string, t long")
    ops = P.keyed_input(_read(spark, src, 1), ["user"], "ts", "id", {"op": "op"}, order="id")
    got = _drain(spark, apply_keyed(ops, ["user"], Repeats(), ["ord", "seq"], initial=before), "init", scratch)
    assert got == [("a", 100_000_000, 1, 5_000_000)]
    with pytest.raises(ValueError):
        apply_keyed(before.withColumn("op", F.lit("error")), ["user"], Repeats(), ["t"], initial=before)


# ------------------------------------------------------------ split folds

def _expected(rows):
    """(id, last error time, sum so far) by a plain fold per key in arrival order."""
    last, total, out = {}, {}, []
    for i, user, sec, op, v in rows:
        out.append((i, last.get(user), total.get(user)))
        if op == "error":
            last[user] = sec
        if v is not None:
            total[user] = total.get(user, 0) + v
    return sorted(out)


PREFIXES = {"prev": Last("op = 'error'", ["sec"]), "run": Sum("v")}


def _pairs(df):
    return df.select("id", F.col("prev.sec").alias("prev_sec"), "run")


@pytest.mark.parametrize("files,width", [(1, 10), (4, 7), (4, 100_000)])
def test_split_folds_equal_a_plain_fold(spark, scratch, files, width):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    rows = [(i, u or None, *r) for i, u, *r in _records(files)]
    _parts(src, rows, files)

    def start():
        df = _read(spark, src, 1).withColumn("ord", F.col("id"))
        return PX.write_prefix(df, ["user"], "ord", "id", PREFIXES, _pairs, out, f"split_{files}_{width}", slice_width=width,
                               trigger=ONCE, checkpoint=os.path.join(scratch, "ck"))

    run_to_end(start(), timeout_s=300)
    got = sorted((r.id, r.prev_sec, r.run) for r in spark.read.parquet(out).collect())
    assert got == _expected(rows)
    more = [(400 + i, u or None, *r) for i, u, *r in _records(9, 50)]
    _write(src, "z", more)
    run_to_end(start(), timeout_s=300)
    got = sorted((r.id, r.prev_sec, r.run) for r in spark.read.parquet(out).collect())
    assert got == _expected(rows + more)


def test_a_hot_key_is_dealt_over_many_slices(spark, scratch):
    """97 % of a micro-batch is one key: its state gets a row per slice, and no
    task scans more than its share of slices."""
    src = os.path.join(scratch, "in")
    rows = [(i, "hot" if i % 33 else f"u{i}", i, "error" if i % 5 == 0 else "view", 1) for i in range(6600)]
    _parts(src, rows, 1)
    df = _read(spark, src).withColumn("ord", F.col("id"))
    seen = {}

    def look(batch, _):
        batch.persist()
        seen["seeds"] = batch.filter("__kind = 2 AND user = 'hot'").count()
        seen["tasks"] = [r["count"] for r in batch.filter("__kind = 0 AND user = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        seen["rows"] = sorted(map(tuple, _pairs(PX.resolved(batch, ["user"], PREFIXES)).collect()))
        batch.unpersist()

    stream = PX.prefix_stream(df, ["user"], "ord", "id", PREFIXES, slice_width=100)
    run_to_end(sinks.write_batches(stream, "hot_split", look, trigger=ONCE, checkpoint=os.path.join(scratch, "ck")), timeout_s=300)
    assert seen["rows"] == _expected(rows)
    assert seen["seeds"] == 66
    assert len(seen["tasks"]) == 4 and max(seen["tasks"]) < 0.5 * 6400


def test_split_sum_refuses_doubles(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "user string, ord long, v double")
    with pytest.raises(TypeError):
        PX.prefix_stream(df, ["user"], "ord", "ord", {"s": Sum("v")})
