"""Plan shape checks: the properties that matter at scale, asserted on the
physical plans of the registered queries."""

import re

import pytest

from trailmix.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def _plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_single_partition(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "SinglePartition" not in p
    # every window function is partitioned by a key
    for spec in re.findall(r"Window \[.*?\], \[(.*?)\], \[", p):
        assert spec.strip(), f"unpartitioned window in {name}"


def test_filters_reach_the_scan(spark):
    p = _plan(QUERIES["repeat_alert"](spark, SF_SMALL))
    assert "EqualTo(event_type,error)" in p
    p = _plan(QUERIES["split_main"](spark, SF_SMALL))
    assert "EqualTo(event_type,click)" in p
    p = _plan(QUERIES["window_join_pairs"](spark, SF_SMALL))
    assert "EqualTo(event_type,click)" in p and "EqualTo(event_type,view)" in p


def test_columns_are_pruned(spark):
    p = _plan(QUERIES["sliding_summary"](spark, SF_SMALL))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", p) == ["ts:timestamp_ntz"]
    p = _plan(QUERIES["session_summary"](spark, SF_SMALL))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", p)) == {"ts:timestamp_ntz,user_id:bigint"}


def test_window_join_has_no_join(spark):
    p = _plan(QUERIES["window_join_pairs"](spark, SF_SMALL))
    assert "Join" not in p
    assert "partial_sum" in p  # both sides combine map-side


def test_hot_key_scans_partition_by_key_and_bucket(spark):
    for name in ["running_sum", "repeat_alert", "action_duration", "session_summary"]:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        # the user (or its never-null stand-ins, value and null flag), then the bucket
        key = r"(?:user_id#\d+L|__kv_user_id#\d+L, __kn_user_id#\d+)"
        assert re.search(rf"Exchange hashpartitioning\({key}, __bucket#\d+L", p), name
        # no full-row exchange on the user alone
        for m in re.finditer(rf"Exchange hashpartitioning\({key}, \d+\)", p):
            tail = p[m.end():m.end() + 400]
            assert "FileScan" not in tail.split("Exchange")[0], name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_aggregations_are_hash_based(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "SortAggregate" not in p


@pytest.mark.parametrize("name", ["running_sum", "repeat_alert", "repeat_alert_strict",
                                  "action_duration", "session_summary"])
def test_per_key_scans_read_and_shuffle_once(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL), final=True)
    final = p.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1
