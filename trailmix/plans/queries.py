"""Registered queries over the driver tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the whole
``events`` table.  The reference's durations (seconds) are scaled to the
table's spread (events per user are hours apart over 30 days), so every
window, gap and threshold is a parameter set here once.

Column mapping (see ``trailmix.schemas``): user <- user_id,
action/operation <- event_type, time <- ts, order <- (ts, event_id),
"Delete" <- error, "Login" <- signup, "Logout" <- purchase,
entity "Customer" <- click.  Records have no arrival time in the table, so
one is derived from the data: ``arrival = ts + round(value * 60) seconds``
(a record's delay in minutes is its value).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmix.functions import hooks
from trailmix.functions import text as TX
from trailmix.operators import joins, keyed, late, routing, watermark, windows
from trailmix.schemas import (EVENT_CUSTOMER, EVENT_DELETE, EVENT_LOGIN, EVENT_LOGOUT,
                              EVENTS_KEY, EVENTS_ORDER, audit_from_events, browser_from_events)
from trailmix.sources import kafka
from trailmix.sources.lines import parse_audit, parse_browser
from trailmix.sources.tables import events as load_events
from trailmix.sources.tables import table

# Parameters of the registered queries.
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "2 hours", "1 hour"
KEYED_WINDOW = "1 day"
SESSION_GAP = "6 hours"
ALERT_WITHIN = "2 days"
JOIN_WINDOW = "1 day"
LATE_WINDOW, LATE_REFRESH, LATE_BUFFER = "1 hour", "2 hours", "30 minutes"
COUNT_LABEL = "Audit Trail : Last window"
JOIN_LEFT_TYPE, JOIN_RIGHT_TYPE = "click", "view"

Query = Callable[[SparkSession, str], DataFrame]


def _with_arrival(ev: DataFrame) -> DataFrame:
    delay_s = F.round(F.col("value") * 60).cast("long")
    return ev.withColumn("arrival", F.timestamp_add("SECOND", delay_s, F.col("ts")))


def tumbling_count(spark, sf):
    """Labelled record count per tumbling window, all keys."""
    return windows.window_count(load_events(spark, sf), "ts", TUMBLE, label=COUNT_LABEL)


def tumbling_count_first(spark, sf):
    """Processing-time window on arrival; key = first record's arrival in ms."""
    ev = _with_arrival(load_events(spark, sf))
    res = windows.window_count_first(ev, "arrival", TUMBLE, "arrival", ["arrival", "event_id"],
                                     carry_out="first_arrival")
    return res.select("window_start", "window_end", "n",
                      F.unix_millis(F.col("first_arrival").cast("timestamp")).alias("first_ms"))


def event_time_count_first(spark, sf):
    """Event-time window; carries the event time of the first-arrived record."""
    ev = _with_arrival(load_events(spark, sf))
    return windows.window_count_first(ev, "ts", TUMBLE, "ts", ["arrival", "event_id"],
                                      carry_out="first_ts")


def user_action_count(spark, sf):
    return windows.window_count(load_events(spark, sf), "ts", KEYED_WINDOW,
                                keys=["user_id", "event_type"])


def sliding_summary(spark, sf):
    return windows.window_summary(load_events(spark, sf), "ts", SLIDE_SIZE, slide=SLIDE_STEP)


def session_summary(spark, sf):
    return windows.session_summary(load_events(spark, sf), EVENTS_KEY, "ts", SESSION_GAP)


def running_sum(spark, sf):
    ev = load_events(spark, sf).withColumn(
        "value_cents", F.round(F.col("value") * 100).cast("long"))
    return keyed.running_sum(ev, EVENTS_KEY, list(EVENTS_ORDER), "value_cents")


def repeat_alert(spark, sf):
    return keyed.repeat_alert(load_events(spark, sf), EVENTS_KEY, list(EVENTS_ORDER),
                              "event_type", EVENT_DELETE, ALERT_WITHIN)


def repeat_alert_strict(spark, sf):
    return keyed.repeat_alert(load_events(spark, sf), EVENTS_KEY, list(EVENTS_ORDER),
                              "event_type", EVENT_DELETE, ALERT_WITHIN, alerts_only=False)


def action_duration(spark, sf):
    return keyed.action_duration(load_events(spark, sf), EVENTS_KEY, list(EVENTS_ORDER),
                                 "event_type", login=EVENT_LOGIN, logout=EVENT_LOGOUT)


def action_duration_summary(spark, sf):
    return keyed.duration_by_action(action_duration(spark, sf))


def _join_pairs(spark, sf):
    ev = load_events(spark, sf)
    left = ev.filter(F.col("event_type") == JOIN_LEFT_TYPE)
    right = ev.filter(F.col("event_type") == JOIN_RIGHT_TYPE)
    return joins.window_join_pairs(left, right, "user_id", "user_id", "ts", "ts", JOIN_WINDOW,
                                   key_out="user_id")


def window_join_pairs(spark, sf):
    return _join_pairs(spark, sf)


def window_join_totals(spark, sf):
    return joins.window_join_totals(_join_pairs(spark, sf), "user_id")


def _is_customer():
    return F.col("event_type") == EVENT_CUSTOMER


def split_main(spark, sf):
    main, _ = routing.split_records(load_events(spark, sf), _is_customer(), "user_id")
    return main


def split_side(spark, sf):
    _, side = routing.split_records(load_events(spark, sf), _is_customer(), "user_id")
    return side


def branch_counts(spark, sf):
    return routing.branch_counts(load_events(spark, sf), _is_customer(), "ts", TUMBLE)


def combine_tagged(spark, sf):
    return routing.split_and_combine(load_events(spark, sf), _is_customer(), "user_id")


def audit_lines(ev: DataFrame) -> DataFrame:
    """Quoted audit-trail lines from events; error events lose their last field."""
    a = audit_from_events(ev).withColumn("__bad", F.col("operation") == EVENT_DELETE)
    six = [F.col(c) for c in ["id", "user", "entity", "operation", "timestamp", "duration"]]
    return a.select(F.when(F.col("__bad"), TX.quote_fields(*six))
                    .otherwise(TX.quote_fields(*six, F.col("count"))).alias("value"))


def ingest_audit(spark, sf):
    parsed, _ = parse_audit(audit_lines(load_events(spark, sf)))
    return parsed.drop("event_time")


def ingest_rejects(spark, sf):
    _, rejects = parse_audit(audit_lines(load_events(spark, sf)))
    return rejects


def ingest_browser(spark, sf):
    b = browser_from_events(load_events(spark, sf))
    lines = b.select(TX.join_fields(F.col("timestamp"), F.col("name"), F.col("action")).alias("value"))
    parsed, _ = parse_browser(lines)
    return parsed.drop("event_time")


def _late_split(spark, sf):
    ev = _with_arrival(load_events(spark, sf))
    return late.split_late(ev, "ts", "arrival", LATE_WINDOW, LATE_REFRESH, LATE_BUFFER)


def late_split_main(spark, sf):
    on_time, _ = _late_split(spark, sf)
    return windows.window_count_first(on_time, "ts", LATE_WINDOW, "ts", ["arrival", "event_id"],
                                      carry_out="first_ts")


def late_split_late(spark, sf):
    _, late_rows = _late_split(spark, sf)
    return late_rows.select("event_id", "user_id", "ts", "arrival")


def exact_watermark(spark, sf):
    """The record-driven watermark that each record meets, and whether it makes it late."""
    ev = _with_arrival(load_events(spark, sf))
    marked = watermark.exact_watermark(ev, "arrival", "event_id", LATE_REFRESH, LATE_BUFFER)
    _, late_rows = watermark.split_late_exact(ev, "ts", "arrival", "event_id", LATE_WINDOW, LATE_REFRESH, LATE_BUFFER)
    return marked.join(late_rows.select("event_id", F.lit(True).alias("is_late")), "event_id", "left").select(
        "event_id", "arrival", "watermark", F.coalesce("is_late", F.lit(False)).alias("is_late"))


def combine_two_inputs(spark, sf):
    """Two tables of different shape on one shape, tagged by origin."""
    ev, orders = load_events(spark, sf), table(spark, sf, "orders")
    return routing.combine_tagged(
        ev, orders,
        [F.col("user_id").alias("who"), F.col("event_type").alias("what"), F.lit(1).alias("n")],
        [F.col("o_custkey").alias("who"), F.col("o_orderstatus").alias("what"), F.lit(1).alias("n")])


def window_join_values(spark, sf):
    """Join on an expression key (user modulo 97), carrying values of each side."""
    ev = load_events(spark, sf)
    left, right = (ev.filter(F.col("event_type") == t) for t in (JOIN_LEFT_TYPE, JOIN_RIGHT_TYPE))
    key = F.col("user_id") % 97
    return joins.window_join_pairs(left, right, key, key, "ts", "ts", JOIN_WINDOW, key_out="user_group",
                                   left_values={"left_first": ("ts", "min"), "left_cents": (F.round(F.col("value") * 100).cast("long"), "sum")},
                                   right_values={"right_last": ("ts", "max")})


def reduced_by_user(spark, sf):
    """A user function (greatest of two, then of all) reduced for each user."""
    ev = load_events(spark, sf).select("user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return hooks.reduce_by_key(ev, ["user_id"], "cents", lambda s: int(s.max()), "long", out="most_cents")


def mapped_records(spark, sf):
    """A user process function: none to two records for each event."""
    def expand(pdf):
        out = pdf.loc[pdf.index.repeat(pdf["event_id"] % 3)].copy()
        out["copy"] = out.groupby(level=0).cumcount()
        return out

    ev = load_events(spark, sf).select("event_id", "event_type")
    return hooks.map_batches(ev, expand, "event_id long, event_type string, copy long")


def kafka_round_trip(spark, sf):
    """Audit lines as Kafka payload bytes, read back and parsed."""
    ev = load_events(spark, sf)
    a = audit_from_events(ev)
    fields = [F.col(c) for c in ["id", "user", "entity", "operation", "timestamp", "duration", "count"]]
    sent = kafka.kafka_payload(a, TX.join_fields(*fields), F.col("id"))
    rows = sent.withColumns({"timestamp": F.lit(None).cast("timestamp"), "partition": F.lit(0), "offset": F.lit(0).cast("long")})
    parsed, _ = parse_audit(kafka.lines_from_kafka_rows(rows))
    return parsed.drop("event_time")


def session_value_summary(spark, sf):
    """Sessions cut on arrival, with the least and greatest event time."""
    ev = _with_arrival(load_events(spark, sf))
    return windows.session_summary(ev, EVENTS_KEY, "arrival", SESSION_GAP, values=["ts"])


def count_messages(spark, sf):
    """Per-window count as ``"<first ts ms> = <n>"`` plus printable times."""
    res = windows.window_count_first(load_events(spark, sf), "ts", TUMBLE, "ts",
                                     list(EVENTS_ORDER), carry_out="first_ts")
    first_ms = F.unix_millis(F.col("first_ts").cast("timestamp"))
    return res.select(
        "window_start", "n",
        TX.key_equals_value(first_ms, F.col("n")).alias("message"),
        TX.clock_text(F.col("window_start")).alias("clock"),
        TX.date_text(F.col("window_start").cast("timestamp")).alias("date_text"),
    )


QUERIES: dict[str, Query] = {
    "tumbling_count": tumbling_count,
    "tumbling_count_first": tumbling_count_first,
    "event_time_count_first": event_time_count_first,
    "user_action_count": user_action_count,
    "sliding_summary": sliding_summary,
    "session_summary": session_summary,
    "running_sum": running_sum,
    "repeat_alert": repeat_alert,
    "repeat_alert_strict": repeat_alert_strict,
    "action_duration": action_duration,
    "action_duration_summary": action_duration_summary,
    "window_join_pairs": window_join_pairs,
    "window_join_totals": window_join_totals,
    "split_main": split_main,
    "split_side": split_side,
    "branch_counts": branch_counts,
    "combine_tagged": combine_tagged,
    "ingest_audit": ingest_audit,
    "ingest_rejects": ingest_rejects,
    "ingest_browser": ingest_browser,
    "late_split_main": late_split_main,
    "late_split_late": late_split_late,
    "exact_watermark": exact_watermark,
    "count_messages": count_messages,
    "combine_two_inputs": combine_two_inputs,
    "window_join_values": window_join_values,
    "reduced_by_user": reduced_by_user,
    "mapped_records": mapped_records,
    "kafka_round_trip": kafka_round_trip,
    "session_value_summary": session_value_summary,
}
