"""A stored history that takes batches in any order, against a rebuild from all changes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import build_history
from tidemark.operators.kept_history import bucket_of, merge_history, read_history
from tidemark.sources.files import list_files

START = datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp, id long, s string, d boolean, note int"
KEYS, ORDER, STATE = ["k"], ["at", "id"], ["s"]


def changes(seed, n=300):
    """Many repeated states and ties, so that late rows part and join versions."""
    r = random.Random(seed)
    keys = ["hot"] * 8 + [f"k{i}" for i in range(8)] + [None]
    return [
        (r.choice(keys), START + timedelta(hours=r.randint(0, 30)), i, r.choice([None, "a", "b"]), r.random() < 0.15, i % 7)
        for i in range(n)
    ]


def shown(df):
    return sorted(str(r.asDict()) for r in df.collect())


def dealt(rows, how, parts, seed=9):
    r = random.Random(seed)
    if how == "in order":
        rows = sorted(rows, key=lambda x: (x[1], x[2]))
    elif how == "newest first":
        rows = sorted(rows, key=lambda x: (x[1], x[2]), reverse=True)
    else:
        rows = r.sample(rows, len(rows))
    cuts = [len(rows) * i // parts for i in range(parts + 1)]
    return [rows[a:b] for a, b in zip(cuts, cuts[1:])]


@pytest.mark.parametrize("how,rows_per_task", [("in order", None), ("newest first", None), ("mixed", None), ("mixed", 20)])
def test_batches_in_any_order_equal_a_rebuild(spark, tmp_path, how, rows_per_task):
    rows, path = changes(3), str(tmp_path / "h")
    for batch in dealt(rows, how, 4):
        merge_history(spark.createDataFrame(batch, SCHEMA), path, KEYS, ORDER, STATE, "d", 8, rows_per_task)
    whole = spark.createDataFrame(rows, SCHEMA)
    expected = build_history(whole, KEYS, ORDER, STATE, "d")
    got = read_history(spark, path, whole.schema, "d")
    assert shown(got.select(*expected.columns)) == shown(expected)


def test_a_late_change_parts_two_equal_states(spark, tmp_path):
    path = str(tmp_path / "h")

    def merge(*rows):
        found = [(k, START + timedelta(hours=h), i, s, d, 0) for k, h, i, s, d in rows]
        merge_history(spark.createDataFrame(found, SCHEMA), path, KEYS, ORDER, STATE, "d", 4)
        versions = read_history(spark, path, spark.createDataFrame([], SCHEMA).schema, "d").orderBy("valid_from").collect()
        hours = lambda t: int((t - START).total_seconds() // 3600)
        return [(r.s, hours(r.valid_from), None if r.is_current else hours(r.valid_to)) for r in versions]

    assert merge(("x", 1, 1, "a", False), ("x", 5, 2, "a", False)) == [("a", 1, None)]
    assert merge(("x", 3, 3, "b", False)) == [("a", 1, 3), ("b", 3, 5), ("a", 5, None)]  # split
    assert merge(("x", 3, 4, "a", False)) == [("a", 1, None)]  # a later row of that instant: joined
    assert merge(("x", 4, 5, None, True)) == [("a", 1, 4), ("a", 5, None)]  # a delete, late
    assert merge(("x", 4, 5, None, True)) == [("a", 1, 4), ("a", 5, None)]  # and once more
    assert merge(("x", 0, 6, "b", False)) == [("b", 0, 1), ("a", 1, 4), ("a", 5, None)]


def test_other_buckets_are_not_rewritten(spark, tmp_path):
    rows, path = changes(5), str(tmp_path / "h")
    whole = spark.createDataFrame(rows, SCHEMA)
    merge_history(whole, path, KEYS, ORDER, STATE, "d", 8)
    before = {r.path for r in list_files(spark, path).collect()}
    late = spark.createDataFrame([("k3", START - timedelta(hours=1), 999, "z", False, 0)], SCHEMA)
    bucket = late.select(bucket_of(KEYS, 8)).first()[0]
    assert merge_history(late, path, KEYS, ORDER, STATE, "d", 8) == [bucket]
    after = {r.path for r in list_files(spark, path).collect()}
    assert before - after and all(f"_bucket={bucket}/" in p for p in before ^ after)
    expected = build_history(whole.union(late), KEYS, ORDER, STATE, "d")
    assert shown(read_history(spark, path, whole.schema, "d").select(*expected.columns)) == shown(expected)


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert merge_history(empty, str(tmp_path / "h"), KEYS, ORDER, STATE, "d") == []
