"""Hand-worked cases: the expected values follow from the reference's rules."""

from pyspark.sql import functions as F

from trailmix.operators import joins, keyed, late, routing, windows
from trailmix.sources.lines import parse_audit, parse_browser


def _browser(spark, rows):
    lines = spark.createDataFrame([(f"{t},u1,{a}",) for t, a in rows], "value string")
    parsed, rejects = parse_browser(lines)
    assert rejects.count() == 0
    return parsed


def test_action_duration_hand_case(spark):
    rows = [(1000, "Login"), (4000, "View Video"), (9000, "Logout"),
            (9500, "View Link"), (9900, "Login"), (10500, "Logout")]
    df = _browser(spark, rows)
    out = keyed.action_duration(df, "name", ["event_time"], "action",
                                login="Login", logout="Logout")
    got = [(r.last_action, r.duration_us // 1000)
           for r in out.orderBy("event_time").collect()]
    assert got == [("None", 0), ("Login", 3000), ("View Video", 5000),
                   ("None", 0), ("None", 0), ("Login", 600)]


def test_action_duration_across_buckets(spark):
    # Bucket width 1 s puts nearly every record in its own bucket, so the
    # carried-over state crosses bucket boundaries.
    rows = [(1000, "Login"), (4000, "View Video"), (9000, "Logout"),
            (9500, "View Link"), (9900, "Login"), (10500, "Logout")]
    df = _browser(spark, rows)
    out = keyed.action_duration(df, "name", ["event_time"], "action",
                                login="Login", logout="Logout", bucket="1 second")
    got = [(r.last_action, r.duration_us // 1000) for r in out.orderBy("event_time").collect()]
    assert got == [("None", 0), ("Login", 3000), ("View Video", 5000),
                   ("None", 0), ("None", 0), ("Login", 600)]


def test_repeat_alert_hand_case(spark):
    # Arrival order differs from time order for the last record.
    rows = [(1, 0, "Delete"), (2, 3000, "Read"), (3, 9999, "Delete"),
            (4, 19999, "Delete"), (5, 19000, "Delete")]
    df = spark.createDataFrame(rows, "seq long, ms long, op string").withColumn(
        "user", F.lit("u1")).withColumn("t", F.timestamp_millis("ms"))
    for bucket in (100, 2):
        strict = keyed.repeat_alert(df, "user", ["seq"], "op", "Delete", "10 seconds",
                                    time_col="t", alerts_only=False, bucket=bucket)
        got = [(r.alert_user, r.interval_us // 1000) for r in strict.orderBy("seq").collect()]
        assert got == [("No Alerts", 0), ("No Alerts", 0), ("u1", 9999),
                       ("No Alerts", 0), ("u1", -999)]
        alerts = keyed.repeat_alert(df, "user", ["seq"], "op", "Delete", "10 seconds",
                                    time_col="t", bucket=bucket)
        assert [r.seq for r in alerts.orderBy("seq").collect()] == [3, 5]


def test_session_gap_exactly_equal_merges(spark):
    df = spark.createDataFrame([("u", 0), ("u", 5000), ("u", 10001)], "user string, ms long") \
        .withColumn("t", F.timestamp_millis("ms"))
    for bucket in ("1 day", "1 second"):
        res = windows.session_summary(df, "user", "t", "5 seconds", bucket=bucket)
        got = sorted((r.n, r.session_start.timestamp()) for r in res.collect())
        assert got == [(1, 10.001), (2, 0.0)]
    native = windows.session_summary_stream(df, "user", "t", "5 seconds")
    assert sorted(r.n for r in native.collect()) == [1, 2]


def test_running_sum_matches_fold(spark):
    rows = [("a", i, v) for i, v in enumerate([3, 1, 4, 1, 5, 9, 2, 6])] + [("b", 0, 7)]
    df = spark.createDataFrame(rows, "user string, seq long, v long")
    out = keyed.running_sum(df, "user", ["seq"], "v", bucket=3)
    got = {(r.user, r.seq): r.running_total for r in out.collect()}
    assert [got[("a", i)] for i in range(8)] == [3, 4, 8, 9, 14, 23, 25, 31]
    assert got[("b", 0)] == 7


def test_tumbling_window_edges(spark):
    df = spark.createDataFrame([(4999,), (5000,), (9999,), (10000,)], "ms long") \
        .withColumn("t", F.timestamp_millis("ms"))
    res = windows.window_count(df, "t", "5 seconds").orderBy("window_start").collect()
    assert [r.n for r in res] == [1, 2, 1]


def test_sliding_row_in_two_windows(spark):
    df = spark.createDataFrame([(7000,)], "ms long").withColumn("t", F.timestamp_millis("ms"))
    res = windows.window_summary(df, "t", "10 seconds", slide="5 seconds")
    assert res.count() == 2


def test_split_sends_null_predicate_to_side(spark):
    df = spark.createDataFrame([("u1", "Customer"), ("u2", "SalesRep"), ("u3", None)],
                               "user string, entity string")
    main, side = routing.split_records(df, F.col("entity") == "Customer", "user")
    assert [r.user for r in main.collect()] == ["u1"]
    assert sorted(r.user for r in side.collect()) == ["u2", "u3"]
    tagged = routing.split_and_combine(df, F.col("entity") == "Customer", "user")
    assert sorted((r.stream_tag, r.user) for r in tagged.collect()) == [
        ("Stream-1", "u1"), ("Stream-2", "u2"), ("Stream-2", "u3")]


def test_combine_tagged_keeps_duplicates(spark):
    a = spark.createDataFrame([("u1", "x"), ("u1", "y")], "user string, op string")
    b = spark.createDataFrame([("u1", 1)], "user string, n int")
    out = routing.combine_tagged(a, b, [F.col("user"), F.lit(1).alias("n")],
                                 [F.col("user"), F.col("n")])
    assert out.count() == 3


def test_window_join_counts_pairs(spark):
    left = spark.createDataFrame([("u", 0), ("u", 1000), ("v", 0)], "user string, ms long") \
        .withColumn("t", F.timestamp_millis("ms"))
    right = spark.createDataFrame([("u", 2000), ("u", 3000), ("u", 4000), ("u", 6000)],
                                  "user string, ms long").withColumn("t", F.timestamp_millis("ms"))
    res = joins.window_join_pairs(left, right, "user", "user", "t", "t", "5 seconds",
                                  key_out="user").collect()
    assert [(r.user, r.left_n, r.right_n, r.pairs) for r in res] == [("u", 2, 3, 6)]


def test_late_split_is_a_partition(spark):
    rows = [(i, i * 700, i * 700 + (i % 5) * 4000) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, et long, arr long") \
        .withColumn("t", F.timestamp_millis("et")).withColumn("a", F.timestamp_millis("arr"))
    on_time, late_rows = late.split_late(df, "t", "a", "1 second", "10 seconds", "2 seconds")
    a, b = on_time.count(), late_rows.count()
    assert a + b == 200 and a > 0 and b > 0
    # The rule by hand for one record: et 0 ms, window [0,1000), arrival 12000:
    # watermark = floor(12000/10000)*10000 - 2000 = 8000 >= 999 -> late.
    one = spark.createDataFrame([(0, 12000)], "et long, arr long") \
        .withColumn("t", F.timestamp_millis("et")).withColumn("a", F.timestamp_millis("arr"))
    assert one.select(late.late_flag(one, "t", "a", "1 second", "10 seconds", "2 seconds")).first()[0]


def test_bad_lines_are_rejected(spark):
    lines = [
        '"1","Ada","Customer","Delete","1575000000000","7","3"',   # ok
        '1,Ada,Customer,Delete,1575000000000,7,3,extra,fields',    # ok, extras ignored
        '"1","Ada","Customer","Delete","1575000000000","7"',       # too few fields
        'x,Ada,Customer,Delete,1575000000000,7,3',                 # non-numeric id
        '',                                                         # blank
        '"1","a,b","Customer","Delete","1575000000000","7","3"',    # quoted comma splits
        '1,Ada,Customer,Delete,1575000000000, 7,3',                # space in number
        '1,Ada,Customer,Delete,1575000000000,7,',                  # trailing empty field
        '1,Ada,Customer,Delete,1575000000000,99999999999,3',       # int overflow
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    parsed, rejects = parse_audit(df)
    ok = parsed.collect()
    assert len(ok) == 2 and all(r.duration == 7 and r.user == "Ada" for r in ok)
    reasons = sorted(r.reason for r in rejects.collect())
    assert len(reasons) == 7
    assert reasons.count("too_few_fields") == 3
    assert "bad_number:id" in reasons and "bad_number:duration" in reasons


def test_user_reduce_and_map_hooks(spark):
    import pandas as pd

    from trailmix.functions.hooks import map_batches, reduce_udf, to_bytes

    df = spark.createDataFrame([(0, 2), (1000, 3), (6000, 4)], "ms long, v long") \
        .withColumn("t", F.timestamp_millis("ms"))
    product = reduce_udf(lambda s: int(s.prod()), "long")
    res = windows.window_agg(df, "t", "5 seconds", [product("v").alias("p")])
    assert sorted(r.p for r in res.collect()) == [4, 6]
    doubled = map_batches(df.select("v"), lambda b: pd.DataFrame({"v2": b["v"] * 2}), "v2 long")
    assert sorted(r.v2 for r in doubled.collect()) == [4, 6, 8]
    assert df.select(to_bytes(F.lit("a = 1"))).first()[0] == bytearray(b"a = 1")
