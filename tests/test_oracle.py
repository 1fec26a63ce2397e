"""Every registered query equals its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from trailmix.plans.oracle import ORACLE
from trailmix.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import _norm
from trailmix.sources.tables import TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["last_action", "n", "total_us", "mean_us"]


# The driver tables hold no (user, day) with millions of rows, so the default
# hot-bucket split never fires on them.  Force it on every (user, day) with
# more than one row: each such bucket is cut into one slice per row's share of
# its span.  The per-key queries must still equal the oracle.
SPLIT_QUERIES = ["session_summary", "running_sum", "repeat_alert", "repeat_alert_strict",
                 "action_duration", "action_duration_summary"]


@pytest.mark.parametrize("name", SPLIT_QUERIES)
def test_forced_split_matches_oracle(spark, duck, monkeypatch, name):
    import functools

    from trailmix.operators import keyed, windows

    for mod, fn in [(keyed, "running_sum"), (keyed, "repeat_alert"),
                    (keyed, "action_duration"), (windows, "session_summary")]:
        monkeypatch.setattr(mod, fn, functools.partial(getattr(mod, fn), max_rows_per_bucket=1))
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.sql(oracle_sql()[name]).df()
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_forced_split_cuts_buckets(spark):
    from trailmix.operators.sequence import bucketed
    from trailmix.sources.tables import events

    ev = events(spark, SF_SMALL)
    plain, _ = bucketed(ev, ["user_id"], "ts", "1 day", None)
    split, bc = bucketed(ev, ["user_id"], "ts", "1 day", 1)
    n_plain = plain.select("user_id", "__bucket").distinct().count()
    n_split = split.select("user_id", *bc).distinct().count()
    assert split.count() == ev.count() and n_split > n_plain
