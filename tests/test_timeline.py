"""Ordered operators against brute force, with plain windows and with slices."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.history import build_history, range_faults
from tidemark.operators.timeline import Timeline

START = datetime(2024, 1, 1)


def _rows(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else (None if rng.random() < 0.1 else f"k{rng.randint(0, 20)}")
        # bunched times with ties
        at = START + timedelta(seconds=int(rng.random() ** 3 * 4000))
        value = rng.choice([None, 1, 2, 3])
        rows.append((key, at, i, value))
    return rows


def _brute(rows):
    result = {}
    by_key = {}
    for row in rows:
        by_key.setdefault(row[0], []).append(row)
    for group in by_key.values():
        group.sort(key=lambda r: (r[1], r[2]))
        total, known = None, None
        for i, (_, _, ident, value) in enumerate(group):
            if value is not None:
                total = value + (total or 0)
            if ident % 3 == 0:
                known = value
            result[ident] = (
                group[i - 1][3] if i else None,
                group[i + 1][3] if i + 1 < len(group) else None,
                known,
                total,
            )
    return result


@pytest.mark.parametrize("rows_per_task", [None, 10, 50])
def test_extend_equals_brute_force(spark, rows_per_task):
    rows = _rows(7)
    df = spark.createDataFrame(rows, "k string, at timestamp, id long, v int")
    timeline = Timeline.of(df, ["k"], ["at", "id"], rows_per_task)
    assert (timeline.cuts is None) == (rows_per_task is None)
    out = timeline.extend(
        timeline.attach(df),
        previous={"p": F.col("v")},
        following={"n": F.col("v")},
        known={"l": (F.col("v"), F.col("id") % 3 == 0)},
        running={"s": F.col("v")},
    )
    got = {r.id: (r.p, r.n, r.l, r.s) for r in out.collect()}
    assert got == _brute(rows)


def test_slices_stay_small(spark):
    rows = [("hot", START + timedelta(seconds=i), i, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, at timestamp, id long, v int")
    timeline = Timeline.of(df, ["k"], ["at", "id"], 20)
    sizes = timeline.attach(df).groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 60


@pytest.mark.parametrize("at", ["timestamp'2024-01-01'", "'2024-01-01T00:00:00'", "concat('2024-01-', lpad(id % 28, 2, '0'))"])
def test_one_instant_and_text_times_are_cut(spark, at):
    rows = spark.range(10_000).selectExpr("'hot' AS k", f"{at} AS at", "id", "1 AS v")
    timeline = Timeline.of(rows, ["k"], ["at", "id"], 100)
    attached = timeline.attach(rows)
    assert attached.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 300
    out = timeline.extend(attached, running={"n": F.col("v")}, previous={"p": F.col("id")}, following={"f": F.col("id")})
    got = sorted((r.at, r.id, r.n, r.p, r.f) for r in out.collect())
    ids = [g[1] for g in got]
    assert [g[2] for g in got] == list(range(1, 10_001))
    assert [g[3] for g in got] == [None, *ids[:-1]] and [g[4] for g in got] == [*ids[1:], None]


def test_small_keys_stay_whole(spark):
    """Only keys that go on from one slice to the next have a slice number."""
    rows = spark.range(2_000).selectExpr("CASE WHEN id < 1500 THEN 'hot' ELSE concat('k', id % 100) END AS k", "id AS at", "1 AS v")
    attached = Timeline.of(rows, ["k"], ["at"], 100).attach(rows)
    whole = attached.filter("_slice = -1").select("k").distinct().count()
    assert whole >= 85
    assert attached.filter("_slice >= 0").filter("k = 'hot'").count() == 1_500


SLICED = [
    "scd2_history", "scd2_current", "scd2_with_deletes", "change_detect", "scd2_overlap_check", "asof_scd2_join", "asof_window_variant",
    "forward_fill", "dim_customer_profile", "dim_product_catalog", "dim_warehouse", "offset_gaps", "stock_running_total",
    "stock_reconcile", "fact_inventory_position", "scd2_incremental",
]


@pytest.mark.parametrize("key", SLICED)
def test_queries_equal_sql_where_keys_are_cut(spark, monkeypatch, key):
    """Every query along a timeline with slices of some thirty rows."""
    import __spark_entry__ as entry
    from oracle import connect, differences
    from tidemark.operators import timeline

    monkeypatch.setattr(timeline, "ONE_TASK_BYTES", 0)
    monkeypatch.setattr(timeline, "ROWS_PER_TASK", 30)
    folder = "/root/testdata/sf0.001"
    assert differences(entry.queries()[key](spark, folder), connect(folder), entry.oracle_sql()[key]) == ""


def _history_brute(rows):
    """rows: (key, at, id, state, deleted)"""
    versions = []
    by_key = {}
    for row in rows:
        by_key.setdefault(row[0], []).append(row)
    for key, group in by_key.items():
        last = {}
        for row in sorted(group, key=lambda r: (r[1], r[2])):
            last[row[1]] = row
        opened = None
        for at in sorted(last):
            _, _, _, state, deleted = last[at]
            now = None if deleted else (state,)
            running = None if opened is None else (opened[1],)
            if now != running:
                if opened is not None:
                    versions.append((key, opened[1], opened[0], at))
                opened = None if deleted else (at, state)
        if opened is not None:
            versions.append((key, opened[1], opened[0], None))
    return sorted(versions, key=str)


@pytest.mark.parametrize("rows_per_task", [None, 15])
def test_history_equals_brute_force(spark, rows_per_task):
    rng = random.Random(3)
    rows = [(k or "null", at, i, None if v is None else str(v), rng.random() < 0.1) for k, at, i, v in _rows(3)]
    df = spark.createDataFrame(rows, "k string, at timestamp, id long, s string, d boolean")
    timeline = Timeline.of(df, ["k"], ["at", "id"], rows_per_task)
    history = build_history(df, ["k"], ["at", "id"], ["s"], "d", timeline)
    got = sorted(
        ((r.k, r.s, r.valid_from, None if r.is_current else r.valid_to) for r in history.collect()), key=str
    )
    assert got == _history_brute(rows)
    assert range_faults(history, ["k"]).filter("fault <> 'gap'").count() == 0


@pytest.mark.parametrize("strategy,rows_per_task", [("auto", None), ("interval", None), ("timeline", None), ("timeline", 12)])
def test_asof_strategies_agree(spark, strategy, rows_per_task):
    rng = random.Random(5)
    versions = []
    for key in ["hot", "k1", "k2"]:
        at = START
        for i in range(40 if key == "hot" else 3):
            end = at + timedelta(seconds=rng.randint(10, 100))
            if rng.random() < 0.8:
                versions.append((key, at, end, f"{key}-{i}"))
            at = end
    history = spark.createDataFrame(versions, "hk string, valid_from timestamp, valid_to timestamp, name string")
    rows = [(k, at, i) for k, at, i, _ in _rows(11)]
    rows += [("hot", versions[0][1], 9001), ("hot", versions[0][2], 9002), ("hot", None, 9003), (None, START, 9004)]
    left = spark.createDataFrame(rows, "k string, at timestamp, id long")
    out = asof_join(left, history, {"k": "hk"}, "at", {"name": "version"}, strategy=strategy, rows_per_task=rows_per_task)
    got = {r.id: r.version for r in out.collect()}
    assert out.count() == len(rows)
    for key, at, ident in rows:
        expected = [v[3] for v in versions if at and v[0] == key and v[1] <= at < v[2]]
        assert got[ident] == (expected[0] if expected else None), (key, at)


def test_history_needs_one_shuffle_and_one_sort(spark):
    df = spark.createDataFrame(_rows(1), "k string, at timestamp, id long, v int")
    history = build_history(df, ["k"], ["at", "id"], ["v"])
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("kind", ["string", "double", "decimal(18,3)", "boolean", "float"])
def test_slices_of_every_order_type_give_the_plain_result(spark, kind):
    rows = spark.range(900).selectExpr(
        "cast(id % 2 AS string) AS k", f"cast(CASE WHEN id % 50 = 7 THEN NULL ELSE (id * 7919 % 613) / 8 - 30 END AS {kind}) AS o",
        "id", "id % 13 AS v",
    )
    def along(limit):
        timeline = Timeline.of(rows, ["k"], ["o", "id"], limit)
        out = timeline.extend(
            timeline.attach(rows), previous={"p": F.col("id")}, running={"total": F.col("v")}, known={"w": (F.col("id"), F.col("v") == 5)}
        )
        return sorted((r.id, r.p, r.total, r.w) for r in timeline.detach(out).collect())

    assert along(40) == along(10_000)


def test_order_types_are_refused_at_every_size(spark):
    rows = spark.createDataFrame([("a", [1])], "k string, o array<int>")
    with pytest.raises(TypeError):
        Timeline.of(rows, ["k"], ["o"])
