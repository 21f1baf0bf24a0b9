"""What the physical plans look like."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from millrace.operators.running import running_totals
from millrace.queries import QUERIES
from millrace.queries.registry import table

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scan_reads_one_column(spark):
    plan = plan_of(QUERIES["src_projected_read"](spark, SF))
    assert "ReadSchema: struct<o_totalprice:double>" in plan


def test_filter_reaches_the_scan(spark):
    plan = plan_of(table(spark, SF, "orders").filter("o_totalprice > 100000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,100000.0)" in plan


@pytest.mark.parametrize("name", ["join_broadcast_left", "join_default_struct", "src_inline_rows", "map_struct_pop"])
def test_small_dimensions_are_broadcast_by_size(spark, name):
    assert "BroadcastHashJoin" in plan_of(QUERIES[name](spark, SF))


def test_large_dimensions_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(QUERIES["join_default_struct"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_a_salted_dimension_is_not_broadcast(spark):
    plan = plan_of(QUERIES["join_salted_lookup"](spark, SF))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["agg_dedup", "topk_per_key", "join_inner_first"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    assert plan_of(QUERIES[name](spark, SF)).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["sink_relational_upsert", "sink_kv_latest", "agg_word_count", "agg_daily_mart", "window_sliding_batch", "dq_checks"])
def test_aggregates_are_partial_first(spark, name):
    assert "partial_" in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["join_inner_first", "agg_dedup"])
def test_windows_shuffle_the_rows_once(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.split("(1)")[0].count("Exchange") <= (1 if name != "join_inner_first" else 2)


def test_running_values_reuse_the_partitioning_of_their_join(spark):
    events = table(spark, SF, "events").select("event_id", "user_id", "ts")
    plan = plan_of(running_totals(events, ["user_id"], ["ts", "event_id"]))
    assert plan.split("(1)")[0].count("Exchange") <= 4   # the rows to their cell; the totals, which are few, to cell, key and back


def test_no_python_and_no_cross_join(spark):
    for name, run in QUERIES.items():
        if name.startswith(("stream_", "vec_", "map_table_", "agg_combiner")):  # Python is what these are for
            continue
        plan = plan_of(run(spark, SF))
        assert not [node for node in (*PYTHON_NODES, *FORBIDDEN) if node in plan], name
