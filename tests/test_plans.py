"""Physical plans: what is read, how often rows move, what stays on the JVM."""

import importlib
import re

import pytest

entry = importlib.import_module("__spark_entry__")

BATCH = [n for n in entry.queries() if not n.endswith("_stream")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)", plan))


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: _plan(entry.queries()[name](spark, sf_dir)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_products(plans, name):
    for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate"):
        assert word not in plans[name], word


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("pv_filter", 0),
        ("bucket_names", 0),
        ("state_events_normalised", 0),
        ("state_events_rejects", 0),
        ("state_events_windowed", 0),
        ("passing_records_windowed", 0),
        ("tumbling_value_sum", 1),
        ("state_events_key_window_counts", 1),
        ("message_running_count", 1),
        ("word_count", 1),
        ("windowed_word_count", 1),
        ("item_window_counts", 2),  # panes, windows
        ("hot_items_topn", 3),  # panes, windows, ranks
    ],
)
def test_number_of_exchanges(plans, name, exchanges):
    assert _exchanges(plans[name]) == exchanges


@pytest.mark.parametrize("name", ["late_audit", "late_audit_by_partition", "on_time_records"])
def test_the_audit_moves_no_records(plans, name):
    """The table of windows is ordered and broadcast; the records meet it where they are read."""
    plan = plans[name]
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan.split("FileScan")[0]
    assert "BroadcastHashJoin" in plan.split("FileScan")[0]


def test_filters_and_columns_reach_the_scan(plans):
    plan = plans["hot_items_topn"]
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan
    assert "ReadSchema: struct<text:string>" in plans["message_running_count"]


def test_rows_are_cut_to_n_before_the_exchange(plans):
    assert re.search(r"WindowGroupLimit .*, 3, Partial", plans["hot_items_topn"])


@pytest.mark.parametrize("name", ["state_events_normalised", "state_events_rejects", "state_events_key_window_counts"])
def test_a_message_is_parsed_hashed_and_timed_once(plans, name):
    plan = plans[name].split("\n\n")[0]
    assert plan.count("from_json(") == 1
    assert plan.count("xxhash64(") == 2  # the message's, and what the parser brought back
    assert plan.count("RLIKE") == 1 and plan.count("try_cast") <= 1


def test_buckets_are_split_and_merged_by_size(spark, sf_dir, folder):
    from windrow.sinks.buckets import BUCKET, with_bucket

    df = with_bucket(spark.sql("select timestamp'2024-01-01' event_time, 1 v")).hint("rebalance", BUCKET)
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(df)
