"""The reference's eight streaming jobs as short compositions.

Each job takes already-opened line streams (``sources.files.stream_lines``
or ``sources.kafka.stream_topic``: a ``value`` text column and an
``arrival_time``), builds its outputs with the same operator functions the
batch queries use, and starts one query per output.  Outputs go to Parquet
(or text) folders under ``out_dir`` by default; pass ``sink`` to send a
result elsewhere (console, memory, Kafka via ``streaming.sinks``).  Each
source is read, parsed and stamped once, into ``<out_dir>/landed``; all outputs
stream from there.  Rejected lines go to ``<out_dir>/rejects``.

Durations default to the reference's values.  Checkpoints go under
``checkpoint_root`` (default: ``<spark.checkpoint.dir>/streams``), one
folder per query, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmix.functions import text as TX
from trailmix.operators import joins, late, routing, windows
from trailmix.functions.time import duration_micros, epoch_micros
from trailmix.schemas import AUDIT_FIELDS, BROWSER_FIELDS, STREAM_TAGS
from trailmix.streaming import processors as P
from trailmix.streaming import sinks
from trailmix.streaming.clock import clock_window_agg
from trailmix.streaming.landing import land
from trailmix.session import checkpoint_location
from trailmix.streaming.stream import watermark

Sink = Callable[[DataFrame, str], StreamingQuery]
# How far event times may trail arrival before a record is late.
DELAY = "1 minute"


def _ck(df: DataFrame, root: str | None, query: str) -> str:
    return checkpoint_location(df.sparkSession, query, root)


def parquet_sink(out_dir: str, prefix: str, trigger: dict | None = None,
                 checkpoint_root: str | None = None) -> Sink:
    def start(df: DataFrame, name: str) -> StreamingQuery:
        q = f"{prefix}_{name}"
        return sinks.write_parquet(df, os.path.join(out_dir, name), q, trigger=trigger,
                                   checkpoint=_ck(df, checkpoint_root, q))
    return start


def _rejects(rejects: DataFrame, out_dir: str, prefix: str, trigger: dict | None,
             root: str | None, part: str = "") -> StreamingQuery:
    q = f"{prefix}_rejects{part}"
    return sinks.write_parquet(rejects, os.path.join(out_dir, f"rejects{part}"), q, trigger=trigger,
                               checkpoint=_ck(rejects, root, q))


def _landed(lines: DataFrame, fields, out_dir: str, prefix: str, trigger: dict | None, root: str | None,
            part: str = ""):
    """The source, read and parsed once, and the queries that land it and its
    bad lines."""
    q = f"{prefix}_landed{part}"
    parsed, rejects, query = land(lines, fields, os.path.join(out_dir, f"landed{part}"), q, trigger=trigger,
                                  checkpoint=_ck(lines, root, q))
    return parsed, {f"landed{part}": query, f"rejects{part}": _rejects(rejects, out_dir, prefix, trigger, root, part)}


def _on_time(df: DataFrame, time_col: str, delay: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a watermark that drops none of them, late rows or None).

    Arrival times of landed rows ascend, so they need no delay.  An event time
    further than ``delay`` behind its arrival goes to the late rows; what is
    left is never behind a watermark of that delay while event times do not run
    ahead of arrival.
    """
    if time_col == "arrival_time":
        return watermark(df, time_col, "0 seconds"), None
    behind = F.coalesce(epoch_micros(df, time_col) < epoch_micros(df, "arrival_time") - F.lit(duration_micros(delay)), F.lit(False))
    return watermark(df.filter(~behind), time_col, delay), df.filter(behind)


def _by_clock(clock: bool | None, time_col: str, trigger: dict | None) -> bool:
    """Whether processing-time windows close by the clock (timers) or by later
    rows: a query that ends by itself has no clock to wait for."""
    ends = bool(trigger) and any(trigger.get(k) for k in ("availableNow", "once"))
    return time_col == "arrival_time" and (not ends if clock is None else clock)


def _late(rows: DataFrame | None, sink: Sink, name: str = "late") -> dict[str, StreamingQuery]:
    return {} if rows is None else {name: sink(rows, name)}


def audit_counts_job(lines: DataFrame, out_dir: str, *, window: str = "5 seconds",
                     label: str = "records in window", clock: bool | None = None, trigger: dict | None = None,
                     sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Labelled count per processing-time window, and the count keyed by the
    window's first arrival (ms) written as ``(first_ms,n)`` text lines.

    ``clock``: windows close when their time is over, also in silence
    (``streaming.clock``); the default wherever the query runs on."""
    prefix = "audit_counts"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    if _by_clock(clock, "arrival_time", trigger):
        stamped = parsed.withColumn("arrival_ms", F.unix_millis("arrival_time"))
        counts = clock_window_agg(stamped, window, {"n": ("*", "count")}).withColumn("label", F.lit(label))
        first = clock_window_agg(stamped, window, {"n": ("*", "count"), "first_ms": ("arrival_ms", "min")})
        line = TX.tuple_text(F.col("first_ms"), F.col("n"))
    else:
        timed, _ = _on_time(parsed, "arrival_time", "0 seconds")
        counts = windows.window_count(timed, "arrival_time", window, label=label)
        first = windows.window_count_first(timed, "arrival_time", window, "arrival_time",
                                           ["arrival_time"], carry_out="first_arrival")
        line = TX.tuple_text(F.unix_millis("first_arrival"), F.col("n"))
    return {
        **qs,
        "counts": sink(counts, "counts"),
        "summary": sinks.write_text(first, line, os.path.join(out_dir, "five_sec_summary"),
                                    f"{prefix}_summary", trigger=trigger,
                                    checkpoint=_ck(first, checkpoint_root, f"{prefix}_summary")),
    }


def running_duration_job(lines: DataFrame, out_dir: str, *, trigger: dict | None = None,
                         sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Running total of ``duration`` per user, one output per record."""
    prefix = "running_duration"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    keyed = P.keyed_input(parsed, ["user"], "event_time", "id", {"value": F.col("duration")})
    return {**qs, "running": sink(P.running_sum_stream(keyed, ["user"]), "running")}


def split_combine_job(lines: DataFrame, out_dir: str, *, window: str = "5 seconds",
                      trigger: dict | None = None, sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Customer records vs the rest: both branches, their counts per window,
    and the recombined tagged stream."""
    prefix = "split_combine"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    is_customer = F.col("entity") == "Customer"
    timed, _ = _on_time(parsed, "arrival_time", "0 seconds")
    return {
        **qs,
        "branches": sinks.write_branches(parsed, is_customer, os.path.join(out_dir, "customer"),
                                         os.path.join(out_dir, "sales_rep"), f"{prefix}_branches",
                                         side_cols=("user",), trigger=trigger,
                                         checkpoint=_ck(parsed, checkpoint_root, f"{prefix}_branches")),
        "branch_counts": sink(routing.branch_counts(timed, is_customer, "arrival_time", window,
                                                    tags=STREAM_TAGS), "branch_counts"),
        "combined": sink(routing.split_and_combine(parsed, is_customer, "user"), "combined"),
    }


def session_job(lines: DataFrame, out_dir: str, *, gap: str = "5 seconds",
                time_col: str = "arrival_time", delay: str = DELAY, trigger: dict | None = None,
                sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Per-user sessions (count, first and last event timestamp).  On event
    time, records more than ``delay`` behind go to ``late``."""
    prefix = "sessions"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    timed, late_rows = _on_time(parsed, time_col, delay)
    res = timed.groupBy("user", F.session_window(time_col, gap).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("min_ts"),
        F.max("timestamp").alias("max_ts"))
    res = res.select("user", "n", "min_ts", "max_ts",
                     F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"))
    return {**qs, "sessions": sink(res, "sessions"), **_late(late_rows, sink)}


def window_join_job(file_lines: DataFrame, kafka_lines: DataFrame, out_dir: str, *,
                    window: str = "5 seconds", time_col: str = "arrival_time", delay: str = DELAY,
                    trigger: dict | None = None, sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Pairs of same-user records from the two streams per tumbling window."""
    prefix = "window_join"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    left, qs = _landed(file_lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root, "_left")
    right, more = _landed(kafka_lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root, "_right")
    qs |= more
    left, late_left = _on_time(left, time_col, delay)
    right, late_right = _on_time(right, time_col, delay)
    qs |= {**_late(late_left, sink, "late_left"), **_late(late_right, sink, "late_right")}
    pairs = joins.window_join_pairs(left, right, "user", "user", time_col, time_col, window,
                                    key_out="user")
    return {**qs, "pairs": sink(pairs, "pairs")}


def event_time_job(lines: DataFrame, out_dir: str, *, window: str = "1 second",
                   refresh: str = "10 seconds", buffer: str = "2 seconds",
                   trigger: dict | None = None, sink: Sink | None = None,
                   message_sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Event-time count per window carrying the first record's timestamp,
    published as ``"<ts> = <n>"``; late records go to their own output."""
    prefix = "event_time"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    on_time, late_rows = late.split_late(parsed, "event_time", "arrival_time", window, refresh, buffer)
    on_time = watermark(on_time, "event_time", late.spark_watermark_delay(refresh, buffer))
    counts = windows.window_count_first(on_time, "event_time", window, "timestamp",
                                        ["arrival_time", "id"], carry_out="first_ts")
    messages = counts.select(TX.key_equals_value(F.col("first_ts"), F.col("n")).alias("message"),
                             "window_start")
    msink = message_sink or (lambda df, name: sinks.write_text(
        df, F.col("message"), os.path.join(out_dir, name), f"{prefix}_{name}", trigger=trigger,
        checkpoint=_ck(df, checkpoint_root, f"{prefix}_{name}")))
    return {**qs, "counts": sink(counts, "counts"), "late": sink(late_rows, "late"),
            "messages": msink(messages, "messages")}


def delete_alert_job(lines: DataFrame, out_dir: str, *, within: str = "10 seconds",
                     trigger: dict | None = None, sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Alert when a user deletes twice within ``within``."""
    prefix = "delete_alert"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, AUDIT_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    keyed = P.keyed_input(parsed, ["user"], "event_time", "id", {"op": F.col("operation")})
    alerts = P.repeat_alert_stream(keyed, ["user"], "Delete", within)
    alerts = alerts.withColumn("message", F.format_string(
        "user %s deleted twice within %d ms",
        F.col("user"), (F.col("interval_us") / 1000).cast("long")))
    return {**qs, "alerts": sink(alerts, "alerts")}


def browser_job(lines: DataFrame, out_dir: str, *, window: str = "10 seconds",
                time_col: str = "arrival_time", delay: str = DELAY, order_col: str | None = None,
                clock: bool | None = None, trigger: dict | None = None,
                sink: Sink | None = None, checkpoint_root: str | None = None) -> dict[str, StreamingQuery]:
    """Capstone: count per (user, action) per window, and how long each user
    spent on each action.  ``clock`` as in ``audit_counts_job``."""
    prefix = "browser"
    sink = sink or parquet_sink(out_dir, prefix, trigger, checkpoint_root)
    parsed, qs = _landed(lines, BROWSER_FIELDS, out_dir, prefix, trigger, checkpoint_root)
    timed, late_rows = _on_time(parsed, time_col, delay)
    counts = (clock_window_agg(parsed, window, {"n": ("*", "count")}, keys=["name", "action"])
              if _by_clock(clock, time_col, trigger) else windows.window_count(timed, time_col, window, keys=["name", "action"]))
    keyed = P.keyed_input(parsed, ["name"], "event_time", None, {"action": F.col("action")}, order=order_col)
    durations = P.action_duration_stream(keyed, ["name"], login="Login", logout="Logout")
    return {**qs, "counts": sink(counts, "counts"), "durations": sink(durations, "durations"),
            **_late(late_rows, sink)}
