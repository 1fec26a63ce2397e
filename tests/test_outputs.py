"""A process function with several typed outputs under one manifest."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trailmix.streaming import outputs as O
from trailmix.streaming.stream import run_to_end

ONCE = {"availableNow": True}
SHAPES = {"whole": "id bigint, user string, v double", "counted": "user string, n int", "bad": "reason string, raw array<bigint>"}


def process(r):
    """Up to three records of three types."""
    if r.user is None:
        yield "bad", ("no user", [r.id, None])
        return
    if r.id % 2 == 0:
        yield "whole", (r.id, r.user, r.v)
    yield "counted", (r.user, 1)


def rows(lo, hi):
    return [(i, None if i % 10 == 7 else f"u{i % 3}", None if i % 4 == 0 else i / 2) for i in range(lo, hi)]


def expected(records):
    out = {n: Counter() for n in SHAPES}
    for i, u, v in records:
        if u is None:
            out["bad"][("no user", (i, None))] += 1
        else:
            if i % 2 == 0:
                out["whole"][(i, u, v)] += 1
            out["counted"][(u, 1)] += 1
    return out


def frame(spark, records):
    return spark.createDataFrame(records, "id long, user string, v double")


def by_expressions(df):
    user = F.col("user").isNotNull()
    return O.tagged(df, {
        "whole": ((F.col("id") % 2 == 0) & user, [F.col("id"), F.col("user"), F.col("v")]),
        "counted": (user, [F.col("user"), F.lit(1).alias("n")]),
        "bad": (~user, [F.lit("no user").alias("reason"), F.array("id", F.lit(None).cast("long")).alias("raw")])})


def contents(df, name):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r)
                   for r in df.filter(F.col("tag") == name).select(f"{name}.*").collect())


def test_both_forms_in_batch(spark):
    df = frame(spark, rows(0, 200))
    want = expected(rows(0, 200))
    for union in (O.tagged_by(df, process, SHAPES), by_expressions(df)):
        assert union.columns == ["tag", *SHAPES]
        assert {n: contents(union, n) for n in SHAPES} == want
        assert union.filter("int(whole IS NOT NULL) + int(counted IS NOT NULL) + int(bad IS NOT NULL) <> 1").count() == 0
    plan = by_expressions(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert O.tagged_by(frame(spark, []), process, SHAPES).count() == 0


def test_null_predicates_and_every_row(spark):
    df = frame(spark, [(1, "a", None), (2, "b", 3.0)])
    union = O.tagged(df, {"all": (None, [F.col("id")]), "high": (F.col("v") > 1, [F.col("v")])})
    assert sorted(r.tag for r in union.collect()) == ["all", "all", "high"]


def test_unknown_output_is_refused(spark):
    with pytest.raises(Exception, match="no output other"):
        O.tagged_by(frame(spark, rows(0, 2)), lambda r: [("other", (1,))], SHAPES).collect()


def test_epochs_replay_and_restart(spark, scratch):
    src, root, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))

    def run():
        df = spark.readStream.schema("id long, user string, v double").parquet(src)
        run_to_end(O.write_outputs(O.tagged_by(df, process, SHAPES), root, "outs", trigger=ONCE, checkpoint=ck))

    def seen(epochs=None):
        return {n: Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in
                           O.read_output(spark, root, n, s, epochs=epochs).drop("epoch").collect()) for n, s in SHAPES.items()}

    frame(spark, rows(0, 100)).write.parquet(src)
    run()
    assert seen() == expected(rows(0, 100)) and O.last_epoch(spark, root) == 0
    # A restart goes on with the next epoch.
    frame(spark, rows(100, 150)).write.mode("append").parquet(src)
    run()
    assert seen() == expected(rows(0, 150)) and seen((1, 1)) == expected(rows(100, 150))
    # An attempt that failed before it was published is not read, in any output.
    frame(spark, rows(500, 600)).transform(lambda d: O.tagged_by(d, process, SHAPES)).write.partitionBy("tag").parquet(f"{root}/data/epoch=2_dead")
    assert seen() == expected(rows(0, 150))
    # A micro-batch that was published but not committed is replayed and changes nothing.
    names = sorted(os.listdir(f"{root}/manifest"))
    with open(f"{ck}/commits/1") as f:
        assert f.read()
    for part in ("1", ".1.crc"):
        if os.path.exists(f"{ck}/commits/{part}"):
            os.remove(f"{ck}/commits/{part}")
    run()
    assert sorted(os.listdir(f"{root}/manifest")) == names and seen() == expected(rows(0, 150))
    # One that was neither is written again, whole.
    for part in ("1", ".1.crc"):
        if os.path.exists(f"{ck}/commits/{part}"):
            os.remove(f"{ck}/commits/{part}")
    os.remove(f"{root}/manifest/{next(n for n in names if n.startswith('1_'))}")
    assert seen() == expected(rows(0, 100))
    run()
    assert seen() == expected(rows(0, 150))


def test_foreign_folder_and_nothing_yet(spark, scratch):
    root = os.path.join(scratch, "out")
    assert O.read_output(spark, root, "counted", SHAPES["counted"]).count() == 0 and O.last_epoch(spark, root) is None
    src = os.path.join(scratch, "in")
    frame(spark, rows(0, 10)).write.parquet(src)
    df = O.tagged_by(spark.readStream.schema("id long, user string, v double").parquet(src), process, SHAPES)
    run_to_end(O.write_outputs(df, root, "outs", trigger=ONCE, checkpoint=os.path.join(scratch, "ck1")))
    with pytest.raises(ValueError):
        O.write_outputs(df, root, "outs", trigger=ONCE, checkpoint=os.path.join(scratch, "ck2"))
