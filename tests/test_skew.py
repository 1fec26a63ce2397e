"""Two-phase per-key scans equal a plain record-by-record fold, including a
hot key that holds most rows and spans many buckets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trailmix.operators import keyed, windows

LOGIN, LOGOUT, DELETE = "signup", "purchase", "error"
TYPES = ["click", "view", LOGIN, LOGOUT, DELETE]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out, seq = [], 0
    for user, n in [(1, 3000), (2, 40), (3, 25), (4, 1)]:
        t = 0
        for _ in range(n):
            t += rnd.choice([0, 1, 2, 5, 30, 400, 4000, 40000])  # seconds; 0 = tie in time
            out.append((seq, user, t, rnd.choice(TYPES), rnd.randint(0, 900)))
            seq += 1
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, event_type string, v long")
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))


def _by_user(rows):
    per = defaultdict(list)
    for r in rows:
        per[r[1]].append(r)
    for u in per:
        per[u].sort(key=lambda r: (r[2], r[0]))
    return per


@pytest.mark.parametrize("bucket", ["1 hour", "1 day", "1000 days"])
def test_running_sum(frame, rows, bucket):
    want = {}
    for u, rs in _by_user(rows).items():
        tot = 0
        for r in rs:
            tot += r[4]
            want[r[0]] = tot
    out = keyed.running_sum(frame, "user_id", ["ts", "event_id"], "v", bucket=bucket)
    assert {r.event_id: r.running_total for r in out.collect()} == want


@pytest.mark.parametrize("bucket", ["1 hour", "1 day"])
def test_action_duration(frame, rows, bucket):
    want = {}
    for u, rs in _by_user(rows).items():
        state = None
        for r in rs:
            pub = ("None", 0)
            if state is not None and r[3] != LOGIN:
                pub = (state[0], (r[2] - state[1]) * 1_000_000)
            state = None if r[3] == LOGOUT else (r[3], r[2])
            want[r[0]] = pub
    out = keyed.action_duration(frame, "user_id", ["ts", "event_id"], "event_type",
                                login=LOGIN, logout=LOGOUT, bucket=bucket)
    assert {r.event_id: (r.last_action, r.duration_us) for r in out.collect()} == want


@pytest.mark.parametrize("bucket", ["1 hour", "1 day"])
def test_repeat_alert(frame, rows, bucket):
    limit = 3600
    want = {}
    for u, rs in _by_user(rows).items():
        last = None
        for r in rs:
            res = ("No Alerts", 0)
            if r[3] == DELETE:
                if last is not None and r[2] - last < limit:
                    res = (str(u), (r[2] - last) * 1_000_000)
                last = r[2]
            want[r[0]] = res
    out = keyed.repeat_alert(frame, "user_id", ["ts", "event_id"], "event_type", DELETE,
                             "1 hour", alerts_only=False, bucket=bucket)
    assert {r.event_id: (r.alert_user, r.interval_us) for r in out.collect()} == want
    alerts = keyed.repeat_alert(frame, "user_id", ["ts", "event_id"], "event_type", DELETE,
                                "1 hour", bucket=bucket)
    assert {r.event_id for r in alerts.collect()} == {k for k, v in want.items() if v[0] != "No Alerts"}


@pytest.mark.parametrize("bucket", ["1 hour", "1 day", "1000 days"])
def test_sessions(frame, rows, bucket):
    gap = 300
    want = []
    for u, rs in _by_user(rows).items():
        cur = None
        for r in rs:
            if cur is None or r[2] - cur[2] > gap:
                if cur:
                    want.append((u, cur[0], cur[2] + gap, cur[1]))
                cur = [r[2], 0, r[2]]
            cur[1] += 1
            cur[2] = r[2]
        want.append((u, cur[0], cur[2] + gap, cur[1]))
    out = windows.session_summary(frame, "user_id", "ts", "5 minutes", bucket=bucket)
    got = [(r.user_id, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n)
           for r in out.collect()]
    assert sorted(got) == sorted(want)


@pytest.fixture(scope="module")
def burst(spark):
    """One user with 3,000 records inside one day (many equal times), plus
    a few light users: one (key, day) bucket holds nearly all rows."""
    rnd = random.Random(11)
    out, seq = [], 0
    for user, n, span in [(1, 3000, 86_000), (2, 30, 10 ** 6), (3, 5, 100)]:
        for _ in range(n):
            out.append((seq, user, rnd.randrange(span) // 7 * 7, rnd.choice(TYPES),
                        rnd.randint(0, 900)))
            seq += 1
    df = spark.createDataFrame(out, "event_id long, user_id long, sec long, event_type string, v long")
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz")), out


def test_hot_bucket_is_split_by_count(burst):
    from trailmix.operators.sequence import bucketed
    frame, _ = burst
    base, bc = bucketed(frame, ["user_id"], ["ts", "event_id"], "1 day", max_rows=200)
    sizes = [r["count"] for r in base.groupBy("user_id", *bc).count().collect()]
    assert len(bc) == 3 and max(sizes) <= 400 and len(sizes) >= 15


SHAPES = {
    "ten_minutes": [43_200 + i * 600 // 20_000 for i in range(20_000)],
    "stray_ends": [0, 86_399, *[43_200 + i % 60 for i in range(20_000)]],
    "one_instant": [43_200] * 20_000,
    "two_instants": [43_200] * 15_000 + [50_000] * 5_000,
    "spread": [i * 4 for i in range(20_000)],
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_slices_are_bounded_for_any_spread(spark, shape):
    """Slices follow the rows, not the clock; an instant is cut by the tie-break."""
    from trailmix.operators.sequence import bucketed
    rows = [(i, 1, sec) for i, sec in enumerate(SHAPES[shape])] + [(i, 2, 7) for i in range(5)]
    frame = spark.createDataFrame(rows, "event_id long, user_id long, sec long").withColumn(
        "ts", F.timestamp_seconds("sec"))
    base, bc = bucketed(frame, ["user_id"], ["ts", "event_id"], "1 day", max_rows=1000)
    sizes = [r["count"] for r in base.groupBy("user_id", *bc).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2000
    # Slices ascend with the order.
    spans = base.filter("user_id = 1").groupBy(*bc).agg(
        F.min(F.struct("ts", "event_id")).alias("lo"), F.max(F.struct("ts", "event_id")).alias("hi")).orderBy(*bc).collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_hot_slices_are_counted_once_for_several_scans(burst):
    """A second scan that is given the slices adds no job before it runs."""
    from trailmix.operators.sequence import hot_slices
    frame, _ = burst
    order = ["ts", "event_id"]
    hot = hot_slices(frame, ["user_id"], order, "1 day", 200)
    assert hot.count() == 1 and hot_slices(frame, ["user_id"], order, "1 day", 10_000) is None
    kw = {"bucket": "1 day", "hot": hot}
    sc = frame.sparkSession.sparkContext
    sc.setJobGroup("shared-slices", "")
    a = keyed.running_sum(frame, "user_id", order, "v", **kw)
    jobs = sc.statusTracker().getJobIdsForGroup("shared-slices")
    sc.setJobGroup("", "")
    assert len(jobs) <= 2                 # the length of the (written) slice list
    b = keyed.running_sum(frame, "user_id", order, "v", max_rows_per_bucket=None)
    assert sorted(a.collect()) == sorted(b.collect())


def test_burst_scans_equal_fold(burst):
    frame, rows = burst
    kw = {"bucket": "1 day", "max_rows_per_bucket": 200}
    per = _by_user(rows)
    want_sum, want_dur, want_alert = {}, {}, {}
    for u, rs in per.items():
        tot, state, last = 0, None, None
        for r in rs:
            tot += r[4]
            want_sum[r[0]] = tot
            pub = ("None", 0)
            if state is not None and r[3] != LOGIN:
                pub = (state[0], (r[2] - state[1]) * 1_000_000)
            state = None if r[3] == LOGOUT else (r[3], r[2])
            want_dur[r[0]] = pub
            res = ("No Alerts", 0)
            if r[3] == DELETE:
                if last is not None and r[2] - last < 60:
                    res = (str(u), (r[2] - last) * 1_000_000)
                last = r[2]
            want_alert[r[0]] = res
    out = keyed.running_sum(frame, "user_id", ["ts", "event_id"], "v", **kw)
    assert {r.event_id: r.running_total for r in out.collect()} == want_sum
    out = keyed.action_duration(frame, "user_id", ["ts", "event_id"], "event_type",
                                login=LOGIN, logout=LOGOUT, **kw)
    assert {r.event_id: (r.last_action, r.duration_us) for r in out.collect()} == want_dur
    out = keyed.repeat_alert(frame, "user_id", ["ts", "event_id"], "event_type", DELETE,
                             "1 minute", alerts_only=False, **kw)
    assert {r.event_id: (r.alert_user, r.interval_us) for r in out.collect()} == want_alert

    gap = 20
    want = []
    for u, rs in per.items():
        cur = None
        for r in rs:
            if cur is None or r[2] - cur[2] > gap:
                if cur:
                    want.append((u, cur[0], cur[2] + gap, cur[1]))
                cur = [r[2], 0, r[2]]
            cur[1] += 1
            cur[2] = r[2]
        want.append((u, cur[0], cur[2] + gap, cur[1]))
    out = windows.session_summary(frame, "user_id", "ts", "20 seconds", **kw)
    got = [(r.user_id, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n)
           for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_reduce_by_key_splits_a_hot_key(spark):
    """A user reduce over a key holding 97% of the rows: level one sees at
    most one input partition's rows of the key; the result equals a direct
    reduction."""
    from trailmix.functions.hooks import reduce_by_key

    rows = [(1 if i % 100 < 97 else 2 + i % 3, i % 1000) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(16)
    res = reduce_by_key(df, ["k"], "v", lambda s: int(s.max()), "long", out="top")
    want = {}
    for k, v in rows:
        want[k] = max(want.get(k, v), v)
    assert {r.k: r.top for r in res.collect()} == want
    partial = df.groupBy("k", F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in partial.filter("k = 1").collect()]
    assert len(sizes) == 16 and max(sizes) < 0.1 * 20_000
