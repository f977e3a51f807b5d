"""Every registered query against its SQL at the smallest scale, and plan checks."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_equals_sql(spark, connection, key):
    frame = entry.queries()[key](spark, SF)
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert frame.count() >= 0
    else:
        assert differences(frame, connection, sql) == ""


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["scd2_history", "dim_warehouse", "fact_order_service", "wire_decode_json", "asof_window_variant"])
def test_no_python_workers(spark, key):
    plan = plan_of(entry.queries()[key](spark, SF))
    assert "Python" not in plan and "MapInPandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_source_filter_prunes_partitions(spark):
    assert "PartitionFilters: [isnotnull(event_source" in plan_of(entry.queries()["partition_prune_source"](spark, SF))


def test_latest_row_is_cut_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["latest_per_key"](spark, SF))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_top_n_is_not_a_total_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["newest_events"](spark, SF))


def test_flagship(spark):
    assert entry.entry(spark).count() == 1500
