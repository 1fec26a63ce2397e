"""The streaming folds, driven directly with a stand-in for Spark's GroupState
across several micro-batches (no Spark needed)."""

import pandas as pd

from trailmix.streaming.processors import (action_duration_fold, repeat_alert_fold,
                                           running_sum_fold)


class State:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None


def _run(fold, batches, col):
    state, out = State(), []
    for rows in batches:
        pdf = pd.DataFrame(rows, columns=["t", "seq", col])
        # rows of one key may arrive split over several Arrow batches
        parts = [pdf.iloc[:1], pdf.iloc[1:]] if len(pdf) > 1 else [pdf]
        out.extend(r for res in fold(("u1",), iter(parts), state) for r in res.itertuples())
    return out


def test_repeat_alert_out_of_order_across_batches():
    ms = 1000
    batches = [[(0, 1, "Delete"), (3000 * ms, 2, "Read")],
               [(9999 * ms, 3, "Delete"), (19999 * ms, 4, "Delete")],
               [(19000 * ms, 5, "Delete"), (19500 * ms, 6, "Delete")]]
    got = _run(repeat_alert_fold(["user"], "Delete", "10 seconds", alerts_only=False), batches, "op")
    assert [(r.alert_user, r.interval_us // ms) for r in got] == [
        ("No Alerts", 0), ("No Alerts", 0), ("u1", 9999), ("No Alerts", 0),
        ("u1", -999), ("u1", 500)]


def test_action_duration_across_batches():
    ms = 1000
    batches = [[(1000 * ms, 1, "Login"), (4000 * ms, 2, "View Video")],
               [(9000 * ms, 3, "Logout")],
               [(9500 * ms, 4, "View Link"), (9900 * ms, 5, "Login"), (10500 * ms, 6, "Logout")]]
    got = _run(action_duration_fold(["user"], "Login", "Logout"), batches, "action")
    assert [(r.last_action, r.duration_us // ms) for r in got] == [
        ("None", 0), ("Login", 3000), ("View Video", 5000), ("None", 0), ("None", 0),
        ("Login", 600)]


def test_running_sum_across_batches():
    got = _run(running_sum_fold(["user"]), [[(2, 1, 5), (1, 2, 3)], [(3, 3, 4)]], "value")
    assert [r.running_total for r in got] == [3, 8, 12]
