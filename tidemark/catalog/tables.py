"""Registered queries: stored tables, table changes and customer analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import workspace
from tidemark.catalog.registry import query
from tidemark.catalog.stand_ins import table
from tidemark.functions.casts import exact_sum, stamp
from tidemark.operators import changes as ops
from tidemark.operators import upkeep
from tidemark.operators.sizing import ONE_TASK_BYTES, input_bytes
from tidemark.plans import analytics
from tidemark.sources import files
from tidemark.sources.tables import append_rows, publish, read_table, register_views, with_month, write_snapshot


def _t(spark, sf_dir, *names):
    return [table(spark, sf_dir, n) for n in names]


_SUM = "cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total"


def _totals(orders: DataFrame, *by: str) -> DataFrame:
    return orders.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("o_totalprice")).cast("double").alias("total")
    )


@query("snapshot_roundtrip", f"SELECT o_orderstatus, count(*) AS rows, {_SUM} FROM orders GROUP BY 1")
def snapshot_roundtrip(spark, sf_dir):
    path = workspace.fresh_folder(spark, "snapshot")
    stored = write_snapshot(table(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    return _totals(stored, "o_orderstatus")


@query(
    "table_append",
    f"""
SELECT o_orderstatus, count(*) AS rows, {_SUM} FROM (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1
""",
)
def table_append(spark, sf_dir):
    path = workspace.fresh_folder(spark, "append")
    orders = table(spark, sf_dir, "orders")
    write_snapshot(orders, path)
    append_rows(orders.filter("o_orderkey % 2 = 0"), path)
    return _totals(read_table(spark, path), "o_orderstatus")


@query(
    "partition_by_month",
    f"SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, count(*) AS rows, {_SUM} FROM orders GROUP BY 1",
)
def partition_by_month(spark, sf_dir):
    path = workspace.fresh_folder(spark, "by-month")
    stored = write_snapshot(with_month(table(spark, sf_dir, "orders"), "o_orderdate"), path, ["month_start"])
    return _totals(stored, "month_start").withColumn("month_start", F.col("month_start").cast("string"))


@query("compact_preserves_rows", f"SELECT o_orderstatus, count(*) AS rows, {_SUM}, true AS fewer_files FROM orders GROUP BY 1")
def compact_preserves_rows(spark, sf_dir):
    root = workspace.fresh_folder(spark, "compact")
    scattered = table(spark, sf_dir, "orders").repartition(16, "o_orderkey")
    scattered.write.partitionBy("o_orderstatus").parquet(f"{root}/before")
    compacted = upkeep.compact(spark, f"{root}/before", f"{root}/after", ["o_orderstatus"])
    files = {
        when: upkeep.file_statistics(spark, f"{root}/{when}").select(
            F.regexp_extract("folder", "o_orderstatus=(.*)$", 1).alias("o_orderstatus"), F.col("files").alias(when)
        )
        for when in ("before", "after")
    }
    fewer = files["before"].join(files["after"], "o_orderstatus").select(
        "o_orderstatus", (F.col("after") < F.col("before")).alias("fewer_files")
    )
    return _totals(compacted, "o_orderstatus").join(fewer, "o_orderstatus")


@query(
    "retain_recent",
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM r
WHERE o_orderdate >= TIMESTAMP '2000-06-01' OR rn <= 1
""",
)
def retain_recent(spark, sf_dir):
    kept = upkeep.retain_recent(
        table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.lit("2000-06-01").cast("timestamp")
    )
    return kept.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "append_only_new",
    """
SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS ids FROM events GROUP BY 1
""",
)
def append_only_new(spark, sf_dir):
    path = workspace.fresh_folder(spark, "only-new")
    events = table(spark, sf_dir, "events")
    write_snapshot(events.filter("event_id % 2 = 0"), path)
    append_rows(upkeep.only_new_records(events.union(events), read_table(spark, path), ["event_id"]), path)
    return read_table(spark, path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids")
    )


@query(
    "delete_where",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 100000)",
)
def delete_where(spark, sf_dir):
    condition = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000)
    return ops.delete_where(table(spark, sf_dir, "orders"), condition).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "update_case_counts",
    """
WITH u AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_acctbal > 5000 THEN 'Premium' WHEN c_acctbal > 1000 THEN 'Standard' ELSE 'Basic' END
    ELSE c_mktsegment END AS segment,
  CASE WHEN c_mktsegment = 'BUILDING' THEN floor(c_acctbal * 1.1::double) ELSE c_acctbal END AS v FROM customer)
SELECT segment, count(*) AS customers, cast(sum(cast(v AS decimal(18,2))) AS double) AS total_value FROM u GROUP BY 1
""",
)
def update_case_counts(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal")
    updated = ops.update_where(
        customer,
        F.col("c_mktsegment") == "BUILDING",
        {
            "c_mktsegment": F.when(balance > 5000, "Premium").when(balance > 1000, "Standard").otherwise("Basic"),
            "c_acctbal": F.floor(balance * 1.1).cast("double"),
        },
    )
    return updated.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), exact_sum(balance).cast("double").alias("total_value")
    )


@query(
    "price_update",
    """
SELECT p_partkey, CASE WHEN p_size > 25 THEN cast(round(cast(p_retailprice AS decimal(18,2)) * 1.075, 2) AS double) ELSE p_retailprice END AS price FROM part
""",
)
def price_update(spark, sf_dir):
    # decimal arithmetic: rounding a price must not depend on how a double prints
    raised = F.round(F.col("price").cast("decimal(18,2)") * F.lit("1.075").cast("decimal(4,3)"), 2).cast("double")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("price"))
    return ops.update_where(parts, F.col("p_size") > 25, {"price": raised}).select("p_partkey", "price")


@query(
    "update_stored",
    f"""
WITH u AS (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders
           WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 50000))
SELECT o_orderstatus, count(*) AS rows, {_SUM} FROM u GROUP BY 1
""",
)
def update_stored(spark, sf_dir):
    path = workspace.fresh_folder(spark, "updated")
    by = ["o_orderstatus"]
    stored = write_snapshot(table(spark, sf_dir, "orders"), path, by)
    status = F.col("o_orderstatus")
    upkeep.update_stored(stored, path, by, (status == "P") & (F.col("o_orderkey") % 2 == 0), {"o_totalprice": F.lit(0.0)})
    stored = spark.read.schema(stored.schema).parquet(path)
    upkeep.delete_stored(stored, path, by, (status == "O") & (F.col("o_totalprice") < 50000))
    return _totals(spark.read.schema(stored.schema).parquet(path), "o_orderstatus")


@query(
    "update_moves_partition",
    f"""
WITH u AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'F' WHEN o_orderkey % 3 = 1 THEN 'a:b/c %=?#' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
  FROM orders)
SELECT o_orderstatus, count(*) AS rows, {_SUM} FROM u GROUP BY 1
""",
)
def update_moves_partition(spark, sf_dir):
    """Rows that move to a partition with other rows, and to one whose name needs escapes."""
    path = workspace.fresh_folder(spark, "moved")
    by = ["o_orderstatus"]
    stored = write_snapshot(table(spark, sf_dir, "orders"), path, by)
    kind = F.col("o_orderkey") % 3
    upkeep.update_stored(stored, path, by, kind == 0, {"o_orderstatus": F.lit("F")})
    upkeep.update_stored(stored, path, by, kind == 1, {"o_orderstatus": F.lit("a:b/c %=?#")})
    return _totals(spark.read.schema(stored.schema).parquet(path), "o_orderstatus")


_ODD_NAMES = ["a:b", "x/y", "50%", "two words", "k=v", "plain", None]


@query(
    "delete_partition_escaped",
    f"""
WITH named AS (SELECT CASE o_orderkey % 7 {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_ODD_NAMES) if n)} END AS name, o_totalprice FROM orders)
SELECT name, count(*) AS rows, {_SUM} FROM named WHERE name IN ('plain', 'k=v') GROUP BY 1
""",
)
def delete_partition_escaped(spark, sf_dir):
    """Whole partitions go, whatever their names are."""
    path = workspace.fresh_folder(spark, "deleted")
    names = F.array(*[F.lit(n) for n in _ODD_NAMES])
    orders = table(spark, sf_dir, "orders").withColumn("name", F.get(names, (F.col("o_orderkey") % 7).cast("int")))
    stored = write_snapshot(orders.select("o_orderkey", "o_totalprice", "name"), path, ["name"])
    for name in _ODD_NAMES:
        if name not in ("plain", "k=v"):
            upkeep.delete_stored(stored, path, ["name"], F.col("name").eqNullSafe(F.lit(name)))
    return _totals(spark.read.schema(stored.schema).parquet(path), "name")


@query(
    "merge_touched_files",
    """
WITH top AS (SELECT max(o_orderkey) AS last FROM orders),
updates AS (SELECT o_orderkey, o_orderpriority, o_totalprice + 1 AS price, o_orderdate + INTERVAL 1 DAY AS changed_at FROM orders, top WHERE o_orderkey < last // 20
  UNION ALL SELECT -1 - o_orderkey, o_orderpriority, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 1000 = 7)
SELECT o_orderkey, o_orderpriority, price, strftime(changed_at, '%Y-%m-%d %H:%M:%S.%f') AS changed_at, true AS others_untouched FROM (
  SELECT * FROM updates UNION ALL
  SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates))
""",
)
def merge_touched_files(spark, sf_dir):
    """A merge of the lowest twentieth of keys and of new ones; the other files keep their names."""
    path = workspace.fresh_folder(spark, "merged")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("changed_at")
    )
    rows.repartitionByRange(16, "o_orderkey").write.parquet(path)
    stored = spark.read.parquet(path)
    last = rows.agg(F.max("o_orderkey")).first()[0]
    raised = rows.filter(F.col("o_orderkey") < last // 20).withColumns(
        {"price": F.col("price") + 1, "changed_at": F.timestamp_add("DAY", F.lit(1), F.col("changed_at"))}
    )
    added = rows.filter("o_orderkey % 1000 = 7").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    before = {r.path for r in files.list_files(spark, path).collect()}
    rewritten = upkeep.merge_stored(stored, path, [], raised.unionByName(added), ["o_orderkey"], ["changed_at"])
    after = {r.path for r in files.list_files(spark, path).collect()}
    untouched = rewritten < len(before) and len(before & after) == len(before) - rewritten
    return spark.read.schema(stored.schema).parquet(path).withColumns(
        {"changed_at": stamp(F.col("changed_at")), "others_untouched": F.lit(untouched)}
    )


@query(
    "compact_binpack",
    f"SELECT o_orderstatus, count(*) AS rows, {_SUM}, true AS fewer_files, true AS large_kept FROM orders GROUP BY 1",
)
def compact_binpack(spark, sf_dir):
    """Small files are merged in place; files above 90 % of the target keep their names."""
    path = workspace.fresh_folder(spark, "binpack")
    orders = table(spark, sf_dir, "orders")
    tasks = max(1, -(-input_bytes(orders) // ONE_TASK_BYTES))  # a file of each status by each of them
    orders.repartition(tasks).write.partitionBy("o_orderstatus").parquet(path)
    large = files.list_files(spark, path).agg(F.min("bytes")).first()[0]
    orders.filter("o_orderkey % 10 = 0").repartition(16 * tasks).write.mode("append").partitionBy("o_orderstatus").parquet(path)
    before = files.list_files(spark, path).collect()
    stored = spark.read.schema(stored_schema_of(orders, "o_orderstatus")).parquet(path)
    upkeep.compact_binpack(spark, path, stored.schema, ["o_orderstatus"], target_bytes=large)
    after = {r.path for r in files.list_files(spark, path).collect()}
    kept = all(r.path in after for r in before if r.bytes >= 0.9 * large)
    rows = spark.read.schema(stored.schema).parquet(path)
    # the copies of every tenth row are taken out again to compare with the table
    once = rows.dropDuplicates(["o_orderkey"])
    return _totals(once, "o_orderstatus").withColumns(
        {"fewer_files": F.lit(len(after) < len(before)), "large_kept": F.lit(kept)}
    )


def stored_schema_of(df: DataFrame, *partition_by: str):
    return files.stored_schema(df.schema, partition_by)


@query(
    "retain_by_partition",
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, true AS recent_untouched FROM r
WHERE o_orderdate >= TIMESTAMP '2000-06-01' OR rn <= 1
""",
)
def retain_by_partition(spark, sf_dir):
    """Retention in place: months after the cutoff keep their files."""
    path = workspace.fresh_folder(spark, "retained")
    stored = write_snapshot(with_month(table(spark, sf_dir, "orders"), "o_orderdate"), path, ["month_start"])
    recent = {r.path for r in files.list_files(spark, path).collect() if r.path.split("month_start=")[1][:10] >= "2000-06-01"}
    upkeep.retain_stored(
        spark, path, stored.schema, ["month_start"], ["o_custkey"], ["o_orderdate", "o_orderkey"], F.lit("2000-06-01").cast("timestamp")
    )
    after = {r.path for r in files.list_files(spark, path).collect()}
    rows = spark.read.schema(stored.schema).parquet(path)
    return rows.select(
        "o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.lit(recent <= after).alias("recent_untouched"),
    )


@query(
    "publish_twice",
    f"SELECT o_orderstatus, count(*) AS rows, {_SUM} FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1",
)
def publish_twice(spark, sf_dir):
    """A second run with fewer partitions and another layout: readers see exactly that run."""
    orders = table(spark, sf_dir, "orders")
    first, second = (workspace.fresh_folder(spark, f"published-{n}") for n in (1, 2))
    name = f"published.orders_{second[-32:]}"
    stored = write_snapshot(orders, first, ["o_orderstatus"])
    publish(spark, name, first, stored.schema)
    stored = write_snapshot(orders.filter("o_orderstatus <> 'F'"), second)
    publish(spark, name, second, stored.schema)
    return _totals(spark.table(name), "o_orderstatus")


# ---- analytics -----------------------------------------------------------------------


@query(
    "segment_analysis",
    """
SELECT c_mktsegment AS segment, count(*) AS customer_count,
       cast(sum(cast(c_acctbal AS decimal(18,2))) AS double) / count(c_acctbal) AS avg_lifetime_value, max(c_acctbal) AS max_lifetime_value
FROM customer GROUP BY 1
""",
)
def segment_analysis(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment")
    return analytics.segment_profile(customers, "segment", "c_acctbal")


@query(
    "monthly_trends",
    """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS order_count,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total_revenue,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) / count(o_totalprice) AS avg_order_value
FROM orders GROUP BY 1, 2
""",
)
def monthly_trends(spark, sf_dir):
    return analytics.monthly_trend(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


@query(
    "monthly_trends_sql",
    """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS order_count,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total_revenue
FROM orders GROUP BY 1, 2
""",
)
def monthly_trends_sql(spark, sf_dir):
    register_views(spark, {"lake_orders": table(spark, sf_dir, "orders")})
    return spark.sql(
        """
        SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS order_count,
               double(sum(cast(o_totalprice AS decimal(18, 2)))) AS total_revenue
        FROM lake_orders
        GROUP BY year(o_orderdate), month(o_orderdate) ORDER BY year, month
        """
    )


@query(
    "customer_order_top10",
    """
SELECT c_custkey, c_name, c_mktsegment, count(o_orderkey) AS total_orders,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total_spent,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) / count(o_totalprice) AS avg_order_value
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3 HAVING count(o_orderkey) > 0
ORDER BY total_spent DESC, c_custkey LIMIT 10
""",
)
def customer_order_top10(spark, sf_dir):
    customer, orders = _t(spark, sf_dir, "customer", "orders")
    named = customer.select("c_custkey", "c_name", "c_mktsegment")
    return analytics.top_customers(named, orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "o_totalprice")


@query(
    "cross_source_join",
    """
SELECT c_custkey, c_name, count(*) AS events, cast(sum(cast(value AS decimal(18,2))) AS double) AS total_value
FROM customer JOIN events ON c_custkey = user_id GROUP BY 1, 2
""",
)
def cross_source_join(spark, sf_dir):
    customer, events = _t(spark, sf_dir, "customer", "events")
    active = events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("events"), exact_sum(F.col("value")).cast("double").alias("total_value")
    )
    return customer.select("c_custkey", "c_name").join(active, "c_custkey")


@query(
    "numeric_summary",
    """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
       min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders
UNION ALL
SELECT 'o_orderkey', count(o_orderkey), round(avg(o_orderkey), 4), round(stddev_samp(o_orderkey), 4), min(o_orderkey), max(o_orderkey) FROM orders
""",
)
def numeric_summary(spark, sf_dir):
    summary = analytics.numeric_summary(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"])
    return summary.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})
