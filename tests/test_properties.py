"""Property tests: on random small inputs, every two-phase scan equals a plain
record-by-record fold for any bucket width (including ties and out-of-order
arrival)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trailmix.operators import keyed, windows

ACTIONS = ["a", "b", "in", "out", "del"]

records = st.lists(
    st.tuples(st.integers(0, 2),                 # user
              st.integers(0, 40),                # time (s)
              st.sampled_from(ACTIONS),          # action
              st.integers(-5, 9)),               # value
    min_size=1, max_size=40)

CFG = settings(max_examples=12, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, recs):
    rows = [(i, u, t, a, v) for i, (u, t, a, v) in enumerate(recs)]
    return spark.createDataFrame(rows, "seq long, user long, sec long, action string, v long") \
        .selectExpr("*", "CAST(timestamp_seconds(sec) AS TIMESTAMP_NTZ) AS ts"), rows


def _per_user(rows, key):
    per = defaultdict(list)
    for r in sorted(rows, key=key):
        per[r[1]].append(r)
    return per


@CFG
@given(recs=records, width=st.sampled_from(["1 second", "7 seconds", "1 day"]))
def test_running_sum_property(spark, recs, width):
    df, rows = _frame(spark, recs)
    want = {}
    for u, rs in _per_user(rows, lambda r: (r[2], r[0])).items():
        tot = 0
        for r in rs:
            tot += r[4]
            want[r[0]] = tot
    out = keyed.running_sum(df, "user", ["ts", "seq"], "v", bucket=width)
    assert {r.seq: r.running_total for r in out.collect()} == want


@CFG
@given(recs=records, width=st.sampled_from([1, 3, 1000]))
def test_repeat_alert_arrival_order_property(spark, recs, width):
    # arrival order = seq, times may go backwards
    df, rows = _frame(spark, recs)
    want = {}
    for u, rs in _per_user(rows, lambda r: r[0]).items():
        last = None
        for r in rs:
            res = ("No Alerts", 0)
            if r[3] == "del":
                if last is not None and r[2] - last < 10:
                    res = (str(u), (r[2] - last) * 1_000_000)
                last = r[2]
            want[r[0]] = res
    out = keyed.repeat_alert(df, "user", ["seq"], "action", "del", "10 seconds",
                             time_col="ts", alerts_only=False, bucket=width)
    assert {r.seq: (r.alert_user, r.interval_us) for r in out.collect()} == want


@CFG
@given(recs=records, width=st.sampled_from([1, 4, 1000]))
def test_action_duration_arrival_order_property(spark, recs, width):
    df, rows = _frame(spark, recs)
    want = {}
    for u, rs in _per_user(rows, lambda r: r[0]).items():
        state = None
        for r in rs:
            pub = ("None", 0)
            if state is not None and r[3] != "in":
                pub = (state[0], (r[2] - state[1]) * 1_000_000)
            state = None if r[3] == "out" else (r[3], r[2])
            want[r[0]] = pub
    out = keyed.action_duration(df, "user", ["seq"], "action", login="in", logout="out",
                                time_col="ts", bucket=width)
    assert {r.seq: (r.last_action, r.duration_us) for r in out.collect()} == want


@CFG
@given(recs=records, width=st.sampled_from(["1 second", "5 seconds", "1 day"]),
       gap=st.integers(0, 6))
def test_sessions_property(spark, recs, width, gap):
    df, rows = _frame(spark, recs)
    want = []
    for u, rs in _per_user(rows, lambda r: (r[2], r[0])).items():
        cur = None
        for r in rs:
            if cur is None or r[2] - cur[2] > gap:
                if cur:
                    want.append((u, cur[0], cur[2] + gap, cur[1]))
                cur = [r[2], 0, r[2]]
            cur[1] += 1
            cur[2] = r[2]
        want.append((u, cur[0], cur[2] + gap, cur[1]))
    out = windows.session_summary(df, "user", "ts", f"{gap} seconds" if gap else 0, bucket=width)
    got = [(r.user, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n)
           for r in out.collect()]
    assert sorted(got) == sorted(want)
