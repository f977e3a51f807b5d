"""Differences by digests and states from kept snapshots, against their plain forms."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests, snapshots
from tidemark.operators.changes import CHANGE_ORDER, state_as_of, state_difference

START = datetime(2024, 1, 1)


def shown(df):
    return sorted(str(r.asDict()) for r in df.collect())


@pytest.fixture(scope="module")
def states(spark):
    before = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id % 7 END AS v", "CASE WHEN id % 2 = 0 THEN 'x' END AS w")
    changed = before.withColumn("v", F.when(F.col("id").isin(5, 900, 17_000), 99).otherwise(F.col("v")))
    # a value that moves from one column to the other, both NULL at times
    changed = changed.withColumns({"w": F.when(F.col("id") == 4_000, F.lit(None)).otherwise(F.col("w"))})
    after = changed.filter("id not in (3, 12000)").union(spark.range(20_000, 20_003).selectExpr("id", "1L", "'n'"))
    return before, after


def test_digests_find_the_whole_difference(spark, states):
    expected = state_difference(*states, ["id"], ["v", "w"])
    got = digests.difference_by_digests(*states, ["id"], ["v", "w"])
    assert expected.count() == 9
    assert shown(got) == shown(expected)


@pytest.mark.parametrize("coarse,fine", [(1, 1), (4, 2), (64, 1_024)])
def test_digests_of_any_number_of_buckets(spark, states, coarse, fine):
    got = digests.difference_by_digests(*states, ["id"], ["v", "w"], coarse=coarse, fine=fine)
    assert shown(got) == shown(state_difference(*states, ["id"], ["v", "w"]))


def test_few_rows_meet_the_join(spark, states):
    before, after = states
    sides = [digests.digests(s, ["id"], ["v", "w"]) for s in states]
    buckets = digests.differing_buckets(*sides)
    assert buckets.count() <= 9
    for side in states:
        assert digests.rows_to_compare(side, buckets, ["id"]).count() < 0.01 * side.count()


def test_equal_states_and_empty_ones(spark, states):
    before, _ = states
    kept = digests.digests(before, ["id"], ["v", "w"])
    shuffled = before.repartition(7, "v")
    assert digests.difference_by_digests(before, shuffled, ["id"], ["v", "w"], kept).count() == 0
    assert digests.difference_by_digests(before.limit(0), before.filter("id < 5"), ["id"], ["v", "w"]).count() == 5
    assert digests.difference_by_digests(before.limit(0), before.limit(0), ["id"], ["v", "w"]).count() == 0


CHANGES = "k string, v int, is_delete boolean, change_ts timestamp, lsn long, bronze_partition int, bronze_offset long"


def changes(seed, n=300):
    r = random.Random(seed)
    return [(f"k{r.randint(0, 40)}", r.randint(0, 9), r.random() < 0.2, START + timedelta(days=r.randint(0, 200)), r.randint(0, 3), 0, i) for i in range(n)]


def test_state_from_snapshots_equals_state_from_all_changes(spark, tmp_path):
    path, rows = str(tmp_path / "s"), spark.createDataFrame(changes(1), CHANGES)
    times = [START + timedelta(days=d) for d in (-1, 0, 40, 41, 90, 150, 151, 300)]
    snapshots.append_changes(rows, path)
    for at in (times[2], times[5]):
        snapshots.keep_state(spark, path, rows.schema, ["k"], at)
    assert snapshots.kept_times(spark, path) == [times[2], times[5]]
    for at in times:
        expected = state_as_of(rows, ["k"], F.lit(at))
        assert shown(snapshots.state_at(spark, path, rows.schema, ["k"], at)) == shown(expected), at


def test_late_changes_drop_the_states_that_they_make_wrong(spark, tmp_path):
    path = str(tmp_path / "s")
    first, second = spark.createDataFrame(changes(2), CHANGES), spark.createDataFrame(changes(3), CHANGES)
    second = second.filter(F.col("change_ts") >= F.lit(START + timedelta(days=60)))
    snapshots.append_changes(first, path)
    for days in (30, 100, 160):
        snapshots.keep_state(spark, path, first.schema, ["k"], START + timedelta(days=days))
    snapshots.append_changes(second, path)
    assert snapshots.kept_times(spark, path) == [START + timedelta(days=30)]
    for days in (29, 30, 61, 100, 170, 250):
        at = START + timedelta(days=days)
        expected = state_as_of(first.union(second), ["k"], F.lit(at), CHANGE_ORDER)
        assert shown(snapshots.state_at(spark, path, first.schema, ["k"], at)) == shown(expected)


def test_folders_before_the_kept_state_are_pruned(spark, tmp_path):
    path, rows = str(tmp_path / "s"), spark.createDataFrame(changes(4), CHANGES)
    snapshots.append_changes(rows, path)
    snapshots.keep_state(spark, path, rows.schema, ["k"], datetime(2024, 5, 10))
    state = snapshots.state_at(spark, path, rows.schema, ["k"], datetime(2024, 6, 20))
    plan = state._jdf.queryExecution().executedPlan().toString()
    filters = " ".join(re.findall(r"PartitionFilters: \[[^\]]*\]", plan))
    assert "2024-05-01" in filters and "2024-06-20" in filters
