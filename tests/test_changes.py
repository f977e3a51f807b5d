"""Change decoding, history and merged feeds on hand-made envelopes."""

import pytest
from pyspark.sql import functions as F

from helpers import at, bronze, change
from tidemark.operators import changes as ops
from tidemark.operators.history import build_history, range_faults
from tidemark.plans import dimensions
from tidemark.schemas import CDC_TABLES

SUPPLIERS = CDC_TABLES["suppliers"]


def supplier(rating, name="n", country="c", ident="s1"):
    return {"supplier_id": ident, "name": name, "country": country, "rating": rating}


def test_every_kind_of_row(spark):
    flat = ("demo.public.suppliers", at("2024-01-01T00:00:09"), 17, 0, '{"supplier_id": "s9", "name": "flat", "rating": "4.5"}', 0, 9)
    broken = ("demo.public.suppliers", at("2024-01-01T00:00:09"), 17, 0, "{not json", 0, 10)
    df = bronze(
        spark,
        [
            change("r", supplier(1.0), "2024-01-01T00:00:00", lsn=1, offset=1),
            change("u", supplier(None), "2024-01-01T00:00:01.250", lsn=2, offset=2),
            change("d", supplier(None), "2024-01-01T00:00:02", lsn=3, offset=3),
            change("c", supplier("bad"), "2024-01-01T00:00:03", lsn=4, offset=4),
            flat,
            broken,
        ],
    )
    rows = {r.bronze_offset: r for r in ops.decode_changes(df, SUPPLIERS).collect()}
    assert rows[1].rating == 1.0 and not rows[1].is_delete
    assert rows[2].rating is None and rows[2].name == "n"
    assert rows[2].change_ts == at("2024-01-01T00:00:01.250")
    assert rows[3].is_delete and rows[3].supplier_id == "s1"
    assert rows[4].rating is None and rows[4].name == "n"
    assert rows[9].supplier_id == "s9" and rows[9].rating == 4.5 and rows[9].change_ts == at("2024-01-01T00:00:09")
    assert rows[10].supplier_id is None
    assert ops.require_columns(ops.decode_changes(df, SUPPLIERS), "supplier_id").count() == 5


def versions(spark, rows, rows_per_task=None):
    dim = dimensions.dim_supplier(bronze(spark, rows), F.lit(0).cast("timestamp"), rows_per_task)
    return [
        (r.rating, r.name, r.valid_from, r.valid_to.year, r.is_current)
        for r in dim.orderBy("supplier_id", "valid_from").collect()
    ]


@pytest.mark.parametrize("rows_per_task", [None, 1])
def test_history_edges(spark, rows_per_task):
    rows = [
        change("r", supplier(1.0), "2024-01-01T00:00:00", 1, 1),
        change("u", supplier(1.0), "2024-01-01T00:01:00", 2, 2),  # nothing changed
        change("u", supplier(2.0), "2024-01-01T00:02:00.100", 3, 3),  # two changes in one second
        change("u", supplier(3.0), "2024-01-01T00:02:00.900", 4, 4),
        change("u", supplier(4.0), "2024-01-01T00:03:00", 5, 5),  # same instant, the later offset wins
        change("u", supplier(5.0), "2024-01-01T00:03:00", 5, 6),
        change("u", supplier(None), "2024-01-01T00:04:00", 6, 7),  # real NULL
        change("u", supplier(None, name=""), "2024-01-01T00:05:00", 7, 8),
        change("u", supplier(None, name=None), "2024-01-01T00:06:00", 8, 9),  # NULL is not empty
        change("u", supplier(None, name="a||b", country="c"), "2024-01-01T00:07:00", 9, 10),
        change("u", supplier(None, name="a", country="b||c"), "2024-01-01T00:08:00", 10, 11),
        change("d", supplier(None, name="a", country="b||c"), "2024-01-01T00:09:00", 11, 12),
        change("d", supplier(None), "2024-01-01T00:09:30", 12, 13),
        change("c", supplier(9.0), "2024-01-01T00:10:00", 13, 14),
        change("r", supplier(7.0, ident="s2"), "2024-01-01T00:00:00", 14, 15),
    ]
    got = versions(spark, rows, rows_per_task)
    starts = [v[2] for v in got]
    assert [v[0] for v in got] == [1.0, 2.0, 3.0, 5.0, None, None, None, None, None, 9.0, 7.0]
    assert [v[1] for v in got[4:9]] == ["n", "", None, "a||b", "a"]
    assert starts[3] == at("2024-01-01T00:03:00") and starts[2] == at("2024-01-01T00:02:00.900")
    assert [v[4] for v in got] == [False] * 9 + [True, True]
    assert [v[3] for v in got] == [2024] * 9 + [2999, 2999]


def test_faults_of_broken_ranges(spark):
    rows = [
        ("a", at("2024-01-01"), at("2024-01-03")),
        ("a", at("2024-01-02"), at("2024-01-04")),
        ("a", at("2024-01-05"), at("2024-01-05")),
        ("b", at("2024-01-01"), at("2024-01-02")),
        ("b", at("2024-01-02"), at("2024-01-03")),
    ]
    faults = range_faults(spark.createDataFrame(rows, "k string, valid_from timestamp, valid_to timestamp"), ["k"])
    assert sorted((r.k, r.fault) for r in faults.collect()) == [("a", "empty"), ("a", "gap"), ("a", "overlap")]


def user(email, country="DE", ident="u1", created="2023-12-31T00:00:00Z"):
    return {"user_id": ident, "email": email, "country": country, "created_at": created}


def segment(name, value, ident="u1"):
    return {"user_id": ident, "segment": name, "lifetime_value": value}


@pytest.mark.parametrize("rows_per_task", [None, 1])
def test_customer_profile_merges_two_feeds(spark, rows_per_task):
    users = bronze(
        spark,
        [
            change("r", user("a"), "2024-01-02T00:00:00", 1, 1),
            change("u", user(None), "2024-01-04T00:00:00", 5, 2),  # a real NULL is not filled
            change("d", user(None), "2024-01-06T00:00:00", 8, 3),
        ],
    )
    segments = bronze(
        spark,
        [
            change("r", segment("Basic", 1.0), "2024-01-01T00:00:00", 2, 1),  # before the user exists
            change("u", segment("Premium", 2.0), "2024-01-03T00:00:00", 3, 2),
            change("u", segment("Premium", 3.0), "2024-01-04T00:00:00", 4, 3),  # same time as the user change
            change("d", segment("Premium", 3.0), "2024-01-05T00:00:00", 6, 4),
            change("u", segment("Basic", 4.0), "2024-01-07T00:00:00", 9, 5),  # after the user is gone
        ],
    )
    dim = dimensions.dim_customer_profile(users, segments, F.lit(0).cast("timestamp"), rows_per_task)
    got = [
        (r.valid_from.day, r.valid_to.day, r.email, r.country, r.segment, r.lifetime_value, r.change_source)
        for r in dim.orderBy("valid_from").collect()
    ]
    assert got == [
        (1, 2, None, None, "Basic", 1.0, "customer_segments"),
        (2, 3, "a", "DE", "Basic", 1.0, "users"),
        (3, 4, "a", "DE", "Premium", 2.0, "customer_segments"),
        (4, 5, None, "DE", "Premium", 3.0, "customer_segments,users"),
        (5, 6, None, "DE", None, None, "customer_segments"),
    ]
    assert dim.filter("is_current").count() == 0


@pytest.mark.parametrize("rows_per_task", [None, 1])
def test_warehouse_keeps_whole_stock(spark, rows_per_task):
    def stock(product, qty, reserved, warehouse="w1"):
        return {"warehouse_id": warehouse, "product_id": product, "qty": qty, "reserved_qty": reserved}

    meta = [
        change("r", {"warehouse_id": w, "name": n, "country": "DE", "region": "EU"}, "2024-01-01T00:00:00", i, i)
        for i, (w, n) in enumerate([("w1", "one"), ("w2", "two")], 1)
    ]
    meta.append(change("u", {"warehouse_id": "w1", "name": "uno", "country": "DE", "region": "EU"}, "2024-01-04T00:00:00", 9, 9))
    moves = [
        change("u", stock("p1", 10, 0), "2024-01-02T00:00:00", 3, 3),
        change("u", stock("p2", 5, 5), "2024-01-02T00:00:00", 4, 4),
        change("u", stock("p1", 7, 5), "2024-01-03T00:00:00", 5, 5),
        change("d", stock("p2", 5, 5), "2024-01-05T00:00:00", 10, 10),
    ]
    dim = dimensions.dim_warehouse(bronze(spark, meta), bronze(spark, moves), F.lit(0).cast("timestamp"), rows_per_task)
    got = [
        (r.warehouse_id, r.valid_from.day, r.name, r.total_qty, r.total_reserved, r.inventory_turnover)
        for r in dim.orderBy("warehouse_id", "valid_from").collect()
    ]
    assert got == [
        ("w1", 1, "one", None, None, None),
        ("w1", 2, "one", 15, 5, 3.0),
        ("w1", 3, "one", 12, 10, 1.2),
        ("w1", 4, "uno", 12, 10, 1.2),
        ("w1", 5, "uno", 7, 5, 1.4),
        ("w2", 1, "two", None, None, None),
    ]


def test_state_and_difference(spark):
    rows = [
        change("c", supplier(1.0, ident="a"), "2024-01-01T00:00:00", 1, 1),
        change("c", supplier(1.0, ident="b"), "2024-01-01T00:00:00", 2, 2),
        change("c", supplier(None, ident="c"), "2024-01-01T00:00:00", 3, 3),
        change("d", supplier(1.0, ident="a"), "2024-01-02T00:00:00", 4, 4),
        change("u", supplier(None, ident="b"), "2024-01-02T00:00:00", 5, 5),
        change("c", supplier(4.0, ident="d"), "2024-01-02T00:00:00", 6, 6),
    ]
    changes = ops.decode_changes(bronze(spark, rows), SUPPLIERS)
    first = ops.state_as_of(changes, ["supplier_id"], F.lit("2024-01-01").cast("timestamp"))
    second = ops.state_as_of(changes, ["supplier_id"], F.lit("2024-01-02").cast("timestamp"))
    assert sorted(r.supplier_id for r in first.collect()) == ["a", "b", "c"]
    diff = ops.state_difference(first, second, ["supplier_id"], ["name", "rating"])
    assert sorted((r.supplier_id, r.change) for r in diff.collect()) == [("a", "removed"), ("b", "changed"), ("d", "added")]


def test_update_delete_upsert_handle_null(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "k int, v double")
    kept = ops.delete_where(df, F.col("v") > 20)
    assert sorted(r.k for r in kept.collect()) == [1, 2]
    updated = ops.update_where(df, F.col("v") > 20, {"v": F.col("v") * 2})
    assert sorted((r.k, r.v) for r in updated.collect()) == [(1, 10.0), (2, None), (3, 60.0)]
    merged = ops.upsert(
        df.withColumn("t", F.lit(1)), spark.createDataFrame([(1, 11.0, 1), (2, 22.0, 0), (4, 4.0, 1), (4, 5.0, 2)], "k int, v double, t int"), ["k"], ["t"]
    )
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, 11.0), (2, None), (3, 30.0), (4, 5.0)]
