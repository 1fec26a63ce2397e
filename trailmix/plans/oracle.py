"""DuckDB SQL equal to each registered query (same column names).

Times are compared in integer microseconds (``epoch_us``); milliseconds
are ``epoch_us // 1000`` because DuckDB's ``epoch_ms`` rounds where
Spark's ``unix_millis`` truncates.  Sums are cast to BIGINT (DuckDB widens
them to HUGEINT).  The per-key sequential queries are written here in
their textbook single-phase form (window over the whole key), which is the
brute-force check of the two-phase Spark plans.
"""

from __future__ import annotations

HOUR = 3_600_000_000
DAY = 24 * HOUR

_ARRIVAL = "ts + to_seconds(CAST(round(value * 60) AS BIGINT))"

_DUR = f"""
  WITH p AS (
    SELECT user_id, ts, event_id, event_type, epoch_us(ts) AS t,
           lag(event_type) OVER w AS pa, lag(epoch_us(ts)) OVER w AS pt
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  q AS (
    SELECT *, (pt IS NOT NULL AND coalesce(pa <> 'purchase', true)
               AND coalesce(event_type <> 'signup', true)) AS ok FROM p)
  SELECT user_id, ts, event_id,
         CASE WHEN ok THEN pa ELSE 'None' END AS last_action,
         CASE WHEN ok THEN t - pt ELSE 0 END AS duration_us
  FROM q"""

_PAIRS = """
  WITH l AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ws, count(*) AS n
             FROM events WHERE event_type = 'click' GROUP BY 1, 2),
       r AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ws, count(*) AS n
             FROM events WHERE event_type = 'view' GROUP BY 1, 2)
  SELECT l.ws AS window_start, l.ws + INTERVAL 1 DAY AS window_end, l.user_id,
         l.n AS left_n, r.n AS right_n, l.n * r.n AS pairs
  FROM l JOIN r ON l.user_id = r.user_id AND l.ws = r.ws"""

_AUDIT = """
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS "user",
         CASE WHEN event_type = 'click' THEN 'Customer' ELSE 'SalesRep' END AS entity,
         event_type AS operation, epoch_us(ts) // 1000 AS "timestamp",
         CAST(round(value) AS INTEGER) AS duration, CAST(length(props) AS INTEGER) AS "count"
  FROM events"""

_LATE = f"""
  WITH a AS (SELECT *, {_ARRIVAL} AS arrival FROM events),
  b AS (SELECT *, epoch_us(ts) AS t, epoch_us(arrival) AS arr FROM a)
  SELECT *, (t - t % {HOUR} + {HOUR} - 1000) <= (arr - arr % {2 * HOUR} - {HOUR // 2}) AS late
  FROM b"""

ORACLE: dict[str, str] = {
    "tumbling_count": """
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n, 'Audit Trail : Last window' AS label
  FROM events GROUP BY 1, 2""",

    "tumbling_count_first": f"""
  WITH a AS (SELECT *, {_ARRIVAL} AS arrival FROM events)
  SELECT date_trunc('hour', arrival) AS window_start,
         date_trunc('hour', arrival) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n, epoch_us(min(arrival)) // 1000 AS first_ms
  FROM a GROUP BY 1, 2""",

    "event_time_count_first": f"""
  WITH a AS (SELECT *, {_ARRIVAL} AS arrival FROM events)
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n, arg_min(ts, {{'a': arrival, 'b': event_id}}) AS first_ts
  FROM a GROUP BY 1, 2""",

    "user_action_count": """
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
         user_id, event_type, count(*) AS n
  FROM events GROUP BY 1, 2, 3, 4""",

    "sliding_summary": """
  WITH w AS (
    SELECT date_trunc('hour', ts) AS window_start, ts FROM events
    UNION ALL
    SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start, ts FROM events)
  SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end,
         count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts
  FROM w GROUP BY 1""",

    "session_summary": f"""
  WITH g AS (
    SELECT user_id, ts, event_id,
           CASE WHEN lag(ts) OVER w IS NULL
                  OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {6 * HOUR} THEN 1 ELSE 0 END AS new
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (
    SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM g)
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
  FROM s GROUP BY user_id, sid""",

    "running_sum": """
  WITH c AS (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) AS value_cents FROM events)
  SELECT user_id, ts, event_id, value_cents,
         CAST(sum(value_cents) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
           AS running_total
  FROM c""",

    "repeat_alert": f"""
  WITH d AS (
    SELECT user_id, ts, event_id, epoch_us(ts) AS t,
           lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p
    FROM events WHERE event_type = 'error')
  SELECT user_id, ts, event_id, t - p AS interval_us
  FROM d WHERE p IS NOT NULL AND t - p < {2 * DAY}""",

    "repeat_alert_strict": f"""
  WITH d AS (
    SELECT user_id, ts, event_id, event_type, epoch_us(ts) AS t,
           max(CASE WHEN event_type = 'error' THEN epoch_us(ts) END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
    FROM events),
  f AS (SELECT *, coalesce(event_type = 'error' AND p IS NOT NULL AND t - p < {2 * DAY}, false) AS fires
        FROM d)
  SELECT user_id, ts, event_id,
         CASE WHEN fires THEN CAST(user_id AS VARCHAR) ELSE 'No Alerts' END AS alert_user,
         CASE WHEN fires THEN t - p ELSE 0 END AS interval_us,
         fires AS is_alert
  FROM f""",

    "action_duration": _DUR,

    "action_duration_summary": f"""
  WITH d AS ({_DUR})
  SELECT last_action, count(*) AS n, CAST(sum(duration_us) AS BIGINT) AS total_us,
         CAST(sum(duration_us) AS BIGINT) / count(*) AS mean_us
  FROM d GROUP BY last_action""",

    "window_join_pairs": _PAIRS,

    "window_join_totals": f"""
  WITH p AS ({_PAIRS})
  SELECT user_id, CAST(sum(pairs) AS BIGINT) AS pairs, count(*) AS windows
  FROM p GROUP BY user_id""",

    "split_main": "SELECT * FROM events WHERE event_type = 'click'",

    "split_side": "SELECT user_id, 1 AS n FROM events WHERE NOT coalesce(event_type = 'click', false)",

    "branch_counts": """
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         CASE WHEN coalesce(event_type = 'click', false) THEN 'Stream-1' ELSE 'Stream-2' END AS stream_tag,
         count(*) AS n
  FROM events GROUP BY 1, 2, 3""",

    "combine_tagged": """
  SELECT CASE WHEN coalesce(event_type = 'click', false) THEN 'Stream-1' ELSE 'Stream-2' END AS stream_tag,
         user_id, 1 AS n
  FROM events""",

    "ingest_audit": f"SELECT * FROM ({_AUDIT}) a WHERE operation <> 'error'",

    "ingest_rejects": f"""
  SELECT '"' || id || '","' || "user" || '","' || entity || '","' || operation || '","'
         || "timestamp" || '","' || duration || '"' AS line,
         'too_few_fields' AS reason
  FROM ({_AUDIT}) a WHERE operation = 'error'""",

    "ingest_browser": """
  SELECT epoch_us(ts) // 1000 AS "timestamp", CAST(user_id AS VARCHAR) AS name, event_type AS action
  FROM events""",

    "late_split_main": f"""
  WITH f AS ({_LATE})
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n, arg_min(ts, {{'a': arrival, 'b': event_id}}) AS first_ts
  FROM f WHERE NOT late GROUP BY 1, 2""",

    "late_split_late": f"""
  WITH f AS ({_LATE})
  SELECT event_id, user_id, ts, arrival FROM f WHERE late""",

    "exact_watermark": f"""
  WITH RECURSIVE a AS (SELECT event_id, epoch_us(ts) AS t, {_ARRIVAL} AS arrival FROM events),
  b AS (SELECT *, epoch_us(arrival) AS arr FROM a),
  d AS (SELECT DISTINCT arr FROM b),
  c(base) AS (SELECT min(arr) FROM d
              UNION ALL
              SELECT * FROM (SELECT min(d.arr) AS base FROM c JOIN d ON d.arr > c.base + {2 * HOUR}) WHERE base IS NOT NULL),
  o AS (SELECT *, row_number() OVER (ORDER BY arr, event_id) AS i FROM b),
  j AS (SELECT o.*, (SELECT max(base) FROM c WHERE base <= o.arr) AS after_us FROM o),
  m AS (SELECT *, lag(after_us) OVER (ORDER BY i) - {HOUR // 2} AS mark FROM j)
  SELECT event_id, arrival, make_timestamp(mark) AS watermark,
         coalesce(t - t % {HOUR} + {HOUR} - 1000 <= mark, false) AS is_late
  FROM m""",

    "count_messages": """
  WITH w AS (
    SELECT date_trunc('hour', ts) AS window_start, count(*) AS n,
           arg_min(ts, {'a': ts, 'b': event_id}) AS first_ts
    FROM events GROUP BY 1)
  SELECT window_start, n,
         CAST(epoch_us(first_ts) // 1000 AS VARCHAR) || ' = ' || CAST(n AS VARCHAR) AS message,
         strftime(window_start, '%H:%M:%S') AS clock,
         strftime(window_start, '%a %b %d %H:%M:%S') || ' UTC ' || strftime(window_start, '%Y') AS date_text
  FROM w""",

    "combine_two_inputs": """
  SELECT 'Stream-1' AS stream_tag, user_id AS who, event_type AS what, 1 AS n FROM events
  UNION ALL
  SELECT 'Stream-2', o_custkey, o_orderstatus, 1 FROM orders""",

    "window_join_values": """
  WITH e AS (SELECT user_id % 97 AS user_group, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ws, ts, event_type,
                    CAST(round(value * 100) AS BIGINT) AS cents FROM events),
       l AS (SELECT user_group, ws, count(*) AS n, min(ts) AS left_first, CAST(sum(cents) AS BIGINT) AS left_cents
             FROM e WHERE event_type = 'click' GROUP BY 1, 2),
       r AS (SELECT user_group, ws, count(*) AS n, max(ts) AS right_last FROM e WHERE event_type = 'view' GROUP BY 1, 2)
  SELECT l.ws AS window_start, l.ws + INTERVAL 1 DAY AS window_end, l.user_group, l.n AS left_n, r.n AS right_n,
         l.n * r.n AS pairs, left_first, left_cents, right_last
  FROM l JOIN r ON l.user_group = r.user_group AND l.ws = r.ws""",

    "reduced_by_user": """
  SELECT user_id, max(CAST(round(value * 100) AS BIGINT)) AS most_cents FROM events GROUP BY user_id""",

    "mapped_records": """
  SELECT event_id, event_type, CAST(c AS BIGINT) AS "copy"
  FROM events JOIN (SELECT 0 AS c UNION ALL SELECT 1) k ON k.c < event_id % 3""",

    "kafka_round_trip": _AUDIT,

    "session_value_summary": f"""
  WITH a AS (SELECT *, {_ARRIVAL} AS arrival FROM events),
  g AS (
    SELECT user_id, ts, arrival, event_id,
           CASE WHEN lag(arrival) OVER w IS NULL
                  OR epoch_us(arrival) - epoch_us(lag(arrival) OVER w) > {6 * HOUR} THEN 1 ELSE 0 END AS new
    FROM a WINDOW w AS (PARTITION BY user_id ORDER BY arrival, event_id)),
  s AS (
    SELECT user_id, ts, arrival, sum(new) OVER (PARTITION BY user_id ORDER BY arrival, event_id
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM g)
  SELECT user_id, min(arrival) AS session_start, max(arrival) + INTERVAL 6 HOUR AS session_end, count(*) AS n,
         min(ts) AS min_ts, max(ts) AS max_ts
  FROM s GROUP BY user_id, sid""",
}
