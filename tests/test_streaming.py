"""Batch = stream: the same rows replayed as files through Structured Streaming."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trailmix.functions import text as TX
from trailmix.operators import keyed, windows
from trailmix.plans import jobs
from trailmix.schemas import audit_from_events, browser_from_events
from trailmix.sources.files import stream_lines
from trailmix.sources.kafka import lines_from_kafka_rows
from trailmix.sources.lines import parse_audit, parse_browser
from trailmix.sources.tables import events
from trailmix.streaming import processors as P
from trailmix.streaming import sinks
from trailmix.streaming.stream import run_to_end

ONCE = {"availableNow": True}
N_FILES = 6


def _write_slices(lines, folder):
    """Write time-ordered slices as files whose modification times follow
    the same order, so the file source takes them oldest first."""
    os.makedirs(folder, exist_ok=True)
    per = (len(lines) + N_FILES - 1) // N_FILES
    now = time.time() - 1000
    for i in range(N_FILES):
        p = os.path.join(folder, f"part_{i:02d}.csv")
        with open(p, "w") as f:
            f.write("\n".join(lines[i * per:(i + 1) * per]) + "\n")
        os.utime(p, (now + i, now + i))


@pytest.fixture(scope="module")
def audit_dir(spark, tmp_path_factory):
    ev = events(spark, SF_SMALL).orderBy("ts", "event_id")
    a = audit_from_events(ev)
    cols = [F.col(c) for c in ["id", "user", "entity", "operation", "timestamp", "duration", "count"]]
    lines = [r.value for r in a.select(TX.quote_fields(*cols).alias("value")).collect()]
    folder = str(tmp_path_factory.mktemp("audit"))
    _write_slices(lines, folder)
    return folder


@pytest.fixture(scope="module")
def browser_dir(spark, tmp_path_factory):
    ev = events(spark, SF_SMALL).orderBy("ts", "event_id")
    b = browser_from_events(ev)
    lines = [r.value for r in b.select(TX.join_fields(F.col("timestamp"), F.col("name"),
                                                      F.col("action")).alias("value")).collect()]
    folder = str(tmp_path_factory.mktemp("browser"))
    _write_slices(lines, folder)
    return folder


def _stream(spark, folder):
    return stream_lines(spark, folder, max_files_per_trigger=1)


def _drain(spark, df, name, scratch, mode="append"):
    q = sinks.write_memory(df, name, mode=mode, trigger=ONCE,
                           checkpoint=os.path.join(scratch, "ckpt", name))
    run_to_end(q, timeout_s=300)
    return spark.table(name)


def test_action_duration_stream_equals_batch(spark, browser_dir, scratch):
    parsed, _ = parse_browser(_stream(spark, browser_dir))
    keyed_in = P.keyed_input(parsed, ["name"], "event_time", None, {"action": F.col("action")})
    out = _drain(spark, P.action_duration_stream(keyed_in, ["name"], login="signup",
                                                 logout="purchase"), "dur_stream", scratch)
    got = {(r.name, r.t, r.last_action, r.duration_us) for r in out.collect()}

    batch, _ = parse_browser(spark.read.text(browser_dir))
    want_df = keyed.action_duration(batch, "name", ["event_time"], "action",
                                    login="signup", logout="purchase")
    want = {tuple(r) for r in want_df.select("name", F.unix_micros("event_time"), "last_action",
                                             "duration_us").collect()}
    assert len(got) == 1000
    assert got == want


def test_repeat_alert_and_running_sum_streams(spark, audit_dir, scratch):
    parsed, _ = parse_audit(_stream(spark, audit_dir))
    k1 = P.keyed_input(parsed, ["user"], "event_time", "id", {"op": F.col("operation")})
    alerts = _drain(spark, P.repeat_alert_stream(k1, ["user"], "error", "2 days"),
                    "alert_stream", scratch)
    k2 = P.keyed_input(parsed, ["user"], "event_time", "id", {"value": F.col("duration")})
    running = _drain(spark, P.running_sum_stream(k2, ["user"]), "sum_stream", scratch)

    batch, _ = parse_audit(spark.read.text(audit_dir))
    want_alerts = keyed.repeat_alert(batch, "user", ["event_time", "id"], "operation",
                                     "error", "2 days")
    assert {(r.user, r.seq, r.interval_us) for r in alerts.collect()} == \
        {(r.user, r.id, r.interval_us) for r in want_alerts.collect()}
    want_sum = keyed.running_sum(batch, "user", ["event_time", "id"], "duration")
    assert {(r.user, r.seq, r.running_total) for r in running.collect()} == \
        {(r.user, r.id, r.running_total) for r in want_sum.collect()}


def test_window_counts_stream_equals_batch(spark, audit_dir, scratch):
    parsed, _ = parse_audit(_stream(spark, audit_dir))
    timed = parsed.withWatermark("event_time", "1 hour")
    out = _drain(spark, windows.window_count(timed, "event_time", "1 hour"), "win_stream",
                 scratch, mode="complete")
    batch, _ = parse_audit(spark.read.text(audit_dir))
    want = windows.window_count(batch, "event_time", "1 hour")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_session_stream_closed_sessions_equal_batch(spark, audit_dir, scratch):
    parsed, _ = parse_audit(_stream(spark, audit_dir))
    timed = parsed.withWatermark("event_time", "0 seconds")
    out = _drain(spark, windows.session_summary_stream(timed, "user", "event_time", "6 hours"),
                 "sess_stream", scratch)
    batch, _ = parse_audit(spark.read.text(audit_dir))
    want = {tuple(r) for r in windows.session_summary(batch, "user", "event_time", "6 hours").collect()}
    got = {tuple(r) for r in out.collect()}
    # Append mode emits a session once the watermark passes its end; sessions
    # still open at end of input stay in state.
    assert got and got <= want


def test_restart_from_checkpoint_has_no_duplicates(spark, scratch):
    src = os.path.join(scratch, "in")
    ev = events(spark, SF_SMALL).orderBy("ts", "event_id")
    cols = [F.col(c) for c in ["id", "user", "entity", "operation", "timestamp", "duration", "count"]]
    lines = [r.value for r in audit_from_events(ev).select(
        TX.quote_fields(*cols).alias("value")).collect()]
    _write_slices(lines[:500], src)
    out_dir, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def run():
        parsed, _ = parse_audit(stream_lines(spark, src, max_files_per_trigger=2))
        k = P.keyed_input(parsed, ["user"], "event_time", "id", {"value": F.col("duration")})
        q = sinks.write_parquet(P.running_sum_stream(k, ["user"]), out_dir, "restart_sum",
                                trigger=ONCE, checkpoint=ck)
        run_to_end(q, timeout_s=300)

    run()
    for i, chunk in enumerate([lines[500:750], lines[750:]]):
        p = os.path.join(src, f"z_{i}.csv")
        with open(p, "w") as f:
            f.write("\n".join(chunk) + "\n")
    run()
    got = spark.read.parquet(out_dir)
    assert got.count() == 1000
    assert got.select("user", "seq").distinct().count() == 1000
    batch, _ = parse_audit(spark.createDataFrame([(v,) for v in lines], "value string"))
    want = keyed.running_sum(batch, "user", ["event_time", "id"], "duration")
    assert {(r.user, r.seq, r.running_total) for r in got.collect()} == \
        {(r.user, r.id, r.running_total) for r in want.collect()}


def test_kafka_rows_parse(spark):
    rows = spark.createDataFrame(
        [(b"1575000000000", b"0,Ada,Customer,Delete,1575000000000,7,3", 0)],
        "key binary, value binary, partition int").withColumns({"timestamp": F.current_timestamp(), "offset": F.lit(5).cast("long")})
    parsed, rejects = parse_audit(lines_from_kafka_rows(rows), keep=["arrival_time"])
    r = parsed.first()
    assert (r.user, r.operation, r.timestamp, r.duration) == ("Ada", "Delete", 1575000000000, 7)
    assert rejects.count() == 0
    kept = lines_from_kafka_rows(rows).first()
    assert (kept.kafka_partition, kept.kafka_offset) == (0, 5) and kept.broker_time is not None


def test_late_split_keeps_null_times(spark):
    from trailmix.operators import late
    rows = spark.createDataFrame([(1, 0, 10), (2, None, 10), (3, 0, None), (4, 0, 10 ** 6)], "id long, t long, a long")
    rows = rows.select("id", F.timestamp_seconds("t").alias("t"), F.timestamp_seconds("a").alias("a"))
    on_time, late_rows = late.split_late(rows, "t", "a", "1 hour", "2 hours", "30 minutes")
    assert sorted(r.id for r in on_time.collect()) == [1, 2, 3] and [r.id for r in late_rows.collect()] == [4]


def test_folds_do_not_depend_on_batch_borders(spark, scratch):
    """Arrival out of time order, in 1, 2 and 4 micro-batches."""
    rows = [(i, "u", t, "error" if i % 2 else "view", i) for i, t in enumerate([5, 20, 19, 8, 40, 39, 41, 2])]
    want = None
    for n in (1, 2, 4):
        src = os.path.join(scratch, f"order{n}")
        os.makedirs(src)
        per, now = len(rows) // n, time.time() - 1000
        for i in range(n):
            p = os.path.join(src, f"{i}.csv")
            with open(p, "w") as f:
                f.writelines(",".join(map(str, r)) + "\n" for r in rows[i * per:(i + 1) * per])
            os.utime(p, (now + i, now + i))
        df = (spark.readStream.schema("id long, user string, sec long, op string, v long").option("maxFilesPerTrigger", 1)
              .csv(src).withColumn("ts", F.timestamp_seconds("sec")))
        alerts = P.repeat_alert_stream(P.keyed_input(df, ["user"], "ts", "id", {"op": "op"}, order="id"), ["user"], "error", "10 seconds")
        spent = P.action_duration_stream(P.keyed_input(df, ["user"], "ts", "id", {"action": "op"}, order="id"), ["user"], login="-", logout="-")
        got = [sorted(map(tuple, _drain(spark, d, f"order_{k}_{n}", scratch).collect())) for k, d in (("alerts", alerts), ("spent", spent))]
        want = want or got
        assert got == want
    assert len(want[0]) == 2 and len(want[1]) == len(rows)


def test_running_sum_refuses_doubles_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, 0.5)], "user long, v double").withColumn("ts", F.current_timestamp())
    with pytest.raises(TypeError):
        P.running_sum_stream(P.keyed_input(df, ["user"], "ts", None, {"value": "v"}), ["user"])


def test_checkpoint_folder_must_be_shared_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from trailmix.session import ensure_checkpoint_dir
    conf = {"spark.master": "spark://somewhere:7077"}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_branches_do_not_overwrite_another_checkpoint(spark, audit_dir, scratch):
    parsed, _ = parse_audit(_stream(spark, audit_dir))
    main, side = os.path.join(scratch, "main"), os.path.join(scratch, "side")

    def start(ck):
        return sinks.write_branches(parsed, F.col("entity") == "Customer", main, side, f"branches_{ck}", trigger=ONCE,
                                    checkpoint=os.path.join(scratch, ck))

    run_to_end(start("one"), timeout_s=300)
    n = spark.read.parquet(main).count() + spark.read.parquet(side).count()
    with pytest.raises(ValueError, match="another checkpoint"):
        start("two")
    run_to_end(start("one"), timeout_s=300)
    assert spark.read.parquet(main).count() + spark.read.parquet(side).count() == n == 1000


def test_jobs_run(spark, audit_dir, browser_dir, scratch):
    out = os.path.join(scratch, "jobs")
    ck = {"trigger": ONCE, "checkpoint_root": os.path.join(scratch, "ckpt")}
    qs = {}
    # On event time, records arrive when they happen.
    def on_the_spot():
        ms = F.split(F.replace("value", F.lit('"'), F.lit("")), ",")[4].cast("long")
        return _stream(spark, audit_dir).withColumn("arrival_time", F.timestamp_millis(ms))

    qs.update(jobs.audit_counts_job(on_the_spot(), os.path.join(out, "a"), **ck))
    qs.update({f"r_{k}": v for k, v in jobs.running_duration_job(
        _stream(spark, audit_dir), os.path.join(out, "r"), **ck).items()})
    qs.update({f"s_{k}": v for k, v in jobs.split_combine_job(
        _stream(spark, audit_dir), os.path.join(out, "s"), **ck).items()})
    qs.update({f"w_{k}": v for k, v in jobs.session_job(
        on_the_spot(), os.path.join(out, "w"), time_col="event_time",
        **ck).items()})
    qs.update({f"j_{k}": v for k, v in jobs.window_join_job(
        on_the_spot(), on_the_spot(), os.path.join(out, "j"),
        time_col="event_time", window="1 day", **ck).items()})
    qs.update({f"d_{k}": v for k, v in jobs.delete_alert_job(
        _stream(spark, audit_dir), os.path.join(out, "d"), within="2 days", **ck).items()})
    qs.update({f"b_{k}": v for k, v in jobs.browser_job(
        _stream(spark, browser_dir), os.path.join(out, "b"), **ck).items()})
    # Event time: arrival = event time + (id mod 5) * 40 minutes; 1 h windows,
    # refresh 2 h, buffer 30 min -> some records on time, some late.
    fields = F.split(F.replace("value", F.lit('"'), F.lit("")), ",")
    delay_ms = F.pmod(fields[0].cast("long"), F.lit(5)) * 40 * 60_000
    lines = _stream(spark, audit_dir).drop("arrival_time").withColumn(
        "arrival_time", F.timestamp_millis(fields[4].cast("long") + delay_ms))
    qs.update({f"e_{k}": v for k, v in jobs.event_time_job(
        lines, os.path.join(out, "e"), window="1 hour", refresh="2 hours", buffer="30 minutes",
        **ck).items()})
    run_to_end(*qs.values(), timeout_s=600)

    assert spark.read.parquet(os.path.join(out, "r", "running")).count() == 1000
    assert spark.read.parquet(os.path.join(out, "s", "combined")).count() == 1000
    cust = spark.read.parquet(os.path.join(out, "s", "customer")).count()
    side = spark.read.parquet(os.path.join(out, "s", "sales_rep")).count()
    assert cust + side == 1000 and cust > 0
    assert spark.read.parquet(os.path.join(out, "b", "durations")).count() == 1000
    pairs = spark.read.parquet(os.path.join(out, "j", "pairs"))
    assert pairs.filter("pairs = left_n * right_n").count() == pairs.count() > 0
    summary = [r.value for r in spark.read.text(os.path.join(out, "a", "five_sec_summary")).collect()]
    assert all(v.startswith("(") and v.endswith(")") for v in summary)
    assert summary
    late_n = spark.read.parquet(os.path.join(out, "e", "late")).count()
    on_time = spark.read.parquet(os.path.join(out, "e", "counts"))
    emitted = on_time.agg(F.sum("n")).first()[0] or 0
    # Every record is late, counted, or in a window that is still open.
    open_rows = sum(r["n"] for r in _still_open(spark, os.path.join(out, "e", "landed"), on_time))
    assert late_n > 0 and emitted > 0 and late_n + emitted + open_rows == 1000
    # One query read each source; the outputs read what it landed.
    assert sum(p["numInputRows"] for p in qs["landed"].recentProgress) == 1000
    for folder in ("a", "r", "s", "w", "d", "b", "e"):
        assert spark.read.parquet(os.path.join(out, folder, "landed")).count() == 1000
    assert all(_dropped(q) == 0 for q in qs.values())
    msgs = [r.value for r in spark.read.text(os.path.join(out, "e", "messages")).collect()]
    assert msgs and all(" = " in m for m in msgs)
    assert glob.glob(os.path.join(out, "d", "alerts", "*.parquet"))


def test_a_running_job_publishes_windows_in_silence(spark, audit_dir, scratch):
    """All rows land at once and none comes after them."""
    out = os.path.join(scratch, "clocked")
    qs = jobs.audit_counts_job(_stream(spark, audit_dir), out, window="2 seconds", trigger={"processingTime": "500 milliseconds"},
                               checkpoint_root=os.path.join(scratch, "ckpt"))
    try:
        end = time.time() + 90
        counts = lines = ()
        while time.time() < end and not (sum(r.n for r in counts) == 1000 and lines):
            time.sleep(0.5)
            assert all(q.exception() is None for q in qs.values())
            if glob.glob(os.path.join(out, "counts", "*.parquet")) and glob.glob(os.path.join(out, "five_sec_summary", "*.txt")):
                counts = spark.read.schema("n long, label string").parquet(os.path.join(out, "counts")).collect()
                lines = [r.value for r in spark.read.text(os.path.join(out, "five_sec_summary")).collect()]
        assert sum(r.n for r in counts) == 1000 and {r.label for r in counts} == {"records in window"}
        assert lines and all(v.startswith("(") and v.endswith(")") for v in lines)
    finally:
        for q in qs.values():
            q.stop()


def _still_open(spark, landed, emitted):
    """Counts of the on-time windows that were not emitted yet."""
    from trailmix.operators import late

    rows = spark.read.parquet(landed).filter("__rec.reason is null").select("arrival_time", F.timestamp_millis("__rec.timestamp").alias("event_time"))
    on_time, _ = late.split_late(rows, "event_time", "arrival_time", "1 hour", "2 hours", "30 minutes")
    want = windows.window_count(on_time, "event_time", "1 hour")
    return want.join(emitted.select("window_start"), "window_start", "left_anti").collect()


def _dropped(q):
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in q.recentProgress for op in p.get("stateOperators", []))


def test_on_time_branch_drops_nothing(spark, scratch):
    """Records arrive in arrival order with delays up to days; Spark's own
    watermark drops rows from the unsplit stream, none from the on-time
    branch of the late split."""
    from trailmix.operators import late

    ev = events(spark, SF_SMALL).selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP) AS et",
        "CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, CAST(round(value * 10) AS INT), 0) AS arr")
    pdf = ev.toPandas().sort_values(["arr", "event_id"]).reset_index(drop=True)
    src = os.path.join(scratch, "arrivals")
    os.makedirs(src)
    n = 40
    per = (len(pdf) + n - 1) // n
    now = time.time() - 1000
    for i in range(n):
        p = os.path.join(src, f"b_{i:03d}.parquet")
        pdf.iloc[i * per:(i + 1) * per].to_parquet(p, index=False, coerce_timestamps="us")
        os.utime(p, (now + i, now + i))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)

    on_time, late_rows = late.split_late(stream, "et", "arr", "1 hour", "2 hours", "30 minutes")
    delay = late.spark_watermark_delay("2 hours", "30 minutes")
    q_main = sinks.write_memory(
        windows.window_count(on_time.withWatermark("et", delay), "et", "1 hour"), "ontime_counts",
        trigger=ONCE, checkpoint=os.path.join(scratch, "ck_main"))
    q_ctl = sinks.write_memory(
        windows.window_count(stream.withWatermark("et", delay), "et", "1 hour"), "control_counts",
        trigger=ONCE, checkpoint=os.path.join(scratch, "ck_ctl"))
    q_late = sinks.write_memory(late_rows, "late_rows", trigger=ONCE,
                                checkpoint=os.path.join(scratch, "ck_late"))
    run_to_end(q_main, q_ctl, q_late, timeout_s=600)
    assert _dropped(q_ctl) > 0
    assert _dropped(q_main) == 0
    assert spark.table("late_rows").count() > 0


def test_observed_metrics_and_console_sink(spark, audit_dir, scratch):
    parsed, rejects = parse_audit(_stream(spark, audit_dir))
    counted = sinks.observed(parsed, "ingest")
    q = sinks.write_memory(counted, "observed_rows", trigger=ONCE,
                           checkpoint=os.path.join(scratch, "ck_obs"))
    run_to_end(q, timeout_s=300)
    seen = sum(p["observedMetrics"]["ingest"]["rows"] for p in q.recentProgress
               if "ingest" in (p.get("observedMetrics") or {}))
    assert seen == spark.table("observed_rows").count() == 1000
    qc = sinks.write_console(rejects, "console_rejects", trigger=ONCE,
                             checkpoint=os.path.join(scratch, "ck_console"))
    run_to_end(qc, timeout_s=300)
