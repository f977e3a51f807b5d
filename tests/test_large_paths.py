"""Plans of large inputs on small rows: what is written, by how many tasks, with which result."""

import pytest
from pyspark.sql import functions as F

from helpers import at, bronze, change
from tidemark import workspace
from tidemark.catalog import QUERIES, changes as catalog_changes, star as catalog_star, tables as catalog_tables
from tidemark.operators import asof, settle as settling
from tidemark.plans import dimensions, facts
from tidemark.sources import files


def labels_of(monkeypatch, *modules):
    """Labels of the tables that the modules ask for."""
    seen = []

    def recorded(df, label, above=0):
        seen.append(label)
        return settling.settle(df, label, above=0)

    for module in modules:
        monkeypatch.setattr(module, "settle", recorded)
    return seen


@pytest.fixture()
def small_tables(spark, tmp_path):
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        (F.col("id") * 1.5).alias("o_totalprice"),
        F.timestamp_add("DAY", (F.col("id") * 5).cast("int"), F.lit("1996-01-01").cast("timestamp")).alias("o_orderdate"),
        F.concat(F.lit("p"), (F.col("id") % 4).cast("string")).alias("o_orderpriority"),
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    lines = orders.select("o_orderkey", "o_orderdate", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    lines.select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 11).alias("l_partkey"), (F.col("o_orderkey") % 3).alias("l_suppkey"),
        F.col("n").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.timestamp_add("DAY", (F.col("n") * 40).cast("int"), F.col("o_orderdate")).alias("l_shipdate"),
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def history(spark, prefix, key, keys):
    rows = [(f"{k}-{n}", k, at(f"2020-0{n}-01"), at(f"2020-0{n + 1}-01")) for k in keys for n in (1, 2, 3)]
    df = spark.createDataFrame(rows, f"{prefix}_sk string, {key} string, valid_from timestamp, valid_to timestamp")
    return df.withColumn(f"{prefix}_nk", F.col(key))


@pytest.mark.parametrize("broadcast", [False, True])
def test_two_lookups_write_the_rows_once(spark, monkeypatch, broadcast):
    rows = [(n, None if n % 9 == 0 else f"u{n % 5}", f"p{n % 4}", at(f"2020-0{n % 5 + 1}-03")) for n in range(60)]
    rows = spark.createDataFrame(rows, "n int, user_id string, product_id string, at timestamp")
    dims = {
        "customer": (history(spark, "customer", "user_id", [f"u{i}" for i in range(3)]), "user_id"),
        "product": (history(spark, "product", "product_id", [f"p{i}" for i in range(40)]), "product_id"),
    }
    expected = rows
    for prefix, (dim, key) in dims.items():
        one = dim.select(F.col(key).alias("_k"), "valid_from", "valid_to", f"{prefix}_sk", f"{prefix}_nk")
        valid = (F.col(key) == F.col("_k")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to"))
        expected = expected.join(one, valid, "left").withColumnRenamed("valid_from", f"{prefix}_valid_from").drop("_k", "valid_to")
    seen = labels_of(monkeypatch, asof, facts)
    monkeypatch.setattr(asof, "ONE_TASK_BYTES", 0)
    small = asof.is_small
    monkeypatch.setattr(asof, "is_small", lambda df: broadcast and "_of_0" in df.columns and small(df))
    got = facts.with_versions(rows, "at", dims, name_versions=True)
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(
        map(str, expected.select(sorted(got.columns)).collect())
    )
    assert seen.count("fact-rows") == 1 and "as-of" not in seen and "as-of-rows" not in seen


def test_warehouse_steps_need_no_table_of_their_own(spark, monkeypatch):
    meta = [change("r", {"warehouse_id": w, "name": w, "country": "x", "region": "y"}, "2020-01-01 00:00:00", 0) for w in "ab"]
    moves = [
        change("u", {"warehouse_id": "ab"[n % 2], "product_id": str(n % 3), "qty": n, "reserved_qty": 1}, f"2020-01-{n + 2:02d} 00:00:00", n, n)
        for n in range(20)
    ]
    seen = labels_of(monkeypatch, dimensions)
    run = F.lit(0).cast("timestamp")
    together = dimensions.dim_warehouse(bronze(spark, meta), bronze(spark, moves), run, 1000)
    assert seen == ["stock"]
    sliced = dimensions.dim_warehouse(bronze(spark, meta), bronze(spark, moves), run, 4)
    assert "warehouse-feeds" in seen
    assert sorted(map(str, together.collect())) == sorted(map(str, sliced.collect()))


def test_orders_to_compact_are_written_by_tasks_of_bounded_size(spark, monkeypatch, small_tables):
    monkeypatch.setattr(catalog_tables, "ONE_TASK_BYTES", 2_000)
    kept = []
    compact = catalog_tables.upkeep.compact_binpack

    def counted(spark, path, *more, **named):
        kept.append(files.list_files(spark, path).count())
        return compact(spark, path, *more, **named)

    monkeypatch.setattr(catalog_tables.upkeep, "compact_binpack", counted)
    rows = QUERIES["compact_binpack"](spark, small_tables).collect()
    assert kept[0] > 3 + 3 * 16 - 6
    assert sum(r["rows"] for r in rows) == 400


@pytest.mark.parametrize("size", [3_000])
def test_streamed_parts_are_written_as_many_files(spark, monkeypatch, small_tables, size):
    monkeypatch.setattr(catalog_star, "ONE_TASK_BYTES", size)
    most = []
    listed = catalog_star.list_files

    def counted(spark, path):
        most.append(listed(spark, path).count())
        return listed(spark, path)

    monkeypatch.setattr(catalog_star, "list_files", counted)
    streamed = QUERIES["stream_order_lifecycle"](spark, small_tables)
    batch = QUERIES["order_lifecycle"](spark, small_tables).select(*streamed.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert most[0] > 5


def test_segments_are_parsed_once_for_all_batches(spark, monkeypatch, small_tables):
    seen = labels_of(monkeypatch, catalog_changes)
    rows = QUERIES["scd2_incremental"](spark, small_tables)
    whole = QUERIES["scd2_with_deletes"](spark, small_tables)
    assert "segment-rows" in seen
    assert sorted(map(str, rows.drop("others_untouched").collect())) == sorted(map(str, whole.collect()))


def test_intermediate_tables_of_dimensions_go(spark, monkeypatch, tmp_path):
    """What a dimension is built from is deleted once the dimension is written."""
    monkeypatch.setattr(workspace, "shared_root", lambda _: str(tmp_path))
    released = []
    monkeypatch.setattr(workspace, "release_shuffles", lambda _: released.append(1))

    def rows(spark, sf_dir, label):
        return settling.settle(spark.range(10).toDF(label), label, above=-1).withColumn("more", F.lit(1))

    one, two = catalog_star._staged(spark, "", lambda *a: rows(*a, "first"), lambda *a: rows(*a, "second"))
    assert one.count() == two.count() == 10 and one.columns == ["first", "more"]
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["dimensions"] and len(released) == 2
