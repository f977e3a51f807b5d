"""Registered queries: dimensions, facts, quality and gold metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import workspace
from tidemark.catalog import sql, stand_ins
from tidemark.catalog.changes import shown_range
from tidemark.catalog.registry import query
from tidemark.catalog.stand_ins import table
from tidemark.functions.casts import safe_ratio, stamp
from tidemark.operators import changes as ops
from tidemark.operators import quality, stock
from tidemark.operators.asof import asof_join
from tidemark.operators.payloads import topic_rows
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.settle import settle
from tidemark.operators.sizing import ONE_TASK_BYTES, input_bytes
from tidemark.operators.timeline import settled
from tidemark.plans import dimensions, facts, gold, star
from tidemark.schemas import CDC_TABLES
from tidemark.sources.files import list_files
from tidemark.sources.tables import side_by_side, write_snapshot
from tidemark.streaming import lifecycle


def _t(spark, sf_dir, *names):
    return [table(spark, sf_dir, n) for n in names]


# ---- dimensions ----------------------------------------------------------------------


def customers(spark, sf_dir) -> DataFrame:
    customer, nation, orders = _t(spark, sf_dir, "customer", "nation", "orders")
    return dimensions.dim_customer_profile(
        stand_ins.user_changes(customer, nation), stand_ins.segment_changes(orders)
    )


def products(spark, sf_dir) -> DataFrame:
    return dimensions.dim_product_catalog(stand_ins.product_changes(*_t(spark, sf_dir, "part", "lineitem")))


def suppliers(spark, sf_dir) -> DataFrame:
    return dimensions.dim_supplier(stand_ins.supplier_changes(*_t(spark, sf_dir, "supplier", "nation")))


def warehouses(spark, sf_dir) -> DataFrame:
    supplier, nation, region, lineitem = _t(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    return dimensions.dim_warehouse(
        stand_ins.warehouse_changes(supplier, nation, region), stand_ins.stock_changes(lineitem)
    )


def calendar(spark, sf_dir) -> DataFrame:
    return dimensions.calendar_of(stand_ins.calendar_bounds(*_t(spark, sf_dir, "orders", "lineitem", "events")))


def _staged(spark, sf_dir, *tables) -> list[DataFrame]:
    """Dimensions built side by side and written once; facts look them up in the written tables."""
    root = workspace.fresh_folder(spark, "dimensions")

    def build(table, number: int) -> DataFrame:
        with workspace.passing(spark):
            return write_snapshot(table(spark, sf_dir), f"{root}/{number}")

    return side_by_side([lambda t=t, number=number: build(t, number) for number, t in enumerate(tables)])


def _shown_dimension(dim: DataFrame, prefix: str) -> DataFrame:
    return shown_range(dim).drop(f"{prefix}_sk", "processed_at")


_RANGE = f"{sql.stamp('valid_from')} AS valid_from, {sql.stamp('valid_to')} AS valid_to, is_current, bronze_partition, bronze_offset"


@query(
    "dim_customer_profile",
    f"""
WITH {sql.CUSTOMER_HISTORY}
SELECT user_id AS customer_nk, user_id, email, country, segment, lifetime_value,
       CASE WHEN email IS NOT NULL THEN '1995-01-01 00:00:00.000000' END AS created_at, change_source, {_RANGE}
FROM c
""",
)
def dim_customer_profile(spark, sf_dir):
    shown = _shown_dimension(customers(spark, sf_dir), "customer")
    return shown.withColumn("created_at", stamp(F.col("created_at")))


@query(
    "dim_product_catalog",
    f"WITH {sql.PRODUCT_HISTORY} SELECT product_id AS product_nk, product_id, title, category, price_usd, {_RANGE} FROM p",
)
def dim_product_catalog(spark, sf_dir):
    return _shown_dimension(products(spark, sf_dir), "product")


_SUPPLIERS = """
sup AS (
  SELECT cast(s_suppkey AS varchar) AS supplier_id, s_name AS name, n_name AS country,
    CASE WHEN step = 0 OR s_suppkey % 7 <> 0 THEN s_acctbal END AS rating,
    CASE step WHEN 0 THEN TIMESTAMP '1995-01-01' WHEN 1 THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '2000-01-01' END AS change_ts,
    s_suppkey * 3 + step AS lsn, 0 AS bronze_partition, s_suppkey * 3 + step AS bronze_offset, step = 2 AS is_delete
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey, (VALUES (0), (1), (2)) v(step)
  WHERE step < 2 OR s_suppkey % 11 = 0)"""


@query(
    "dim_supplier",
    f"""
WITH {_SUPPLIERS}, {sql.history('sup', 's', ['supplier_id'], sql.CHANGE_ORDER, ['name', 'country', 'rating'], 'is_delete')}
SELECT supplier_id AS supplier_nk, supplier_id, name, country, rating, {_RANGE} FROM s
""",
)
def dim_supplier(spark, sf_dir):
    return _shown_dimension(suppliers(spark, sf_dir), "supplier")


@query(
    "dim_warehouse",
    f"""
WITH {sql.WAREHOUSE_HISTORY}
SELECT warehouse_id AS warehouse_nk, warehouse_id, name, region, country, total_qty, total_reserved,
       CASE WHEN total_reserved <> 0 THEN total_qty::double / total_reserved::double END AS inventory_turnover, {_RANGE}
FROM w
""",
)
def dim_warehouse(spark, sf_dir):
    return _shown_dimension(warehouses(spark, sf_dir), "warehouse")


@query(
    "dim_date",
    """
WITH bounds AS (
  SELECT date_trunc('year', least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem), (SELECT min(ts) FROM events))) AS a,
         date_trunc('year', greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem), (SELECT max(ts) FROM events))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b),
days AS (SELECT unnest(generate_series(a::timestamp, b::timestamp, INTERVAL 1 DAY)) AS d FROM bounds),
placed AS (SELECT cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
  dayofweek(d) + 1 AS day_of_week, dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, monthname(d) AS month_name,
  dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, day(d) = 1 AS is_month_start,
  day(d + INTERVAL 1 DAY) = 1 AS is_month_end, day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS is_quarter_start,
  day(d) = 1 AND month(d) = 1 AS is_year_start, day(d) = 31 AND month(d) = 12 AS is_year_end,
  coalesce(n, 0) AS orders
FROM days LEFT JOIN placed ON cast(d AS date) = placed.day
""",
)
def dim_date(spark, sf_dir):
    dates = calendar(spark, sf_dir).drop("date_sk", "processed_at")
    placed = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return dates.join(placed, "date_key", "left").fillna(0, ["orders"]).withColumn(
        "date_key", F.col("date_key").cast("string")
    )


# ---- stock ---------------------------------------------------------------------------


def _stock_rows(spark, sf_dir) -> DataFrame:
    bronze = stand_ins.stock_changes(table(spark, sf_dir, "lineitem"))
    return ops.require_columns(
        ops.decode_changes(bronze, CDC_TABLES["warehouse_inventory"]), "warehouse_id", "product_id"
    )


_TURNOVER = "CASE WHEN total_reserved <> 0 THEN total_qty::double / total_reserved::double END AS inventory_turnover"

_BATCH_SQL = f"""
WITH t AS (SELECT cast(l_suppkey AS varchar) AS warehouse_id, l_shipdate, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS total_qty,
  cast(sum(l_linenumber) AS bigint) AS total_reserved, max(l_orderkey * 8 + l_linenumber) AS bronze_offset FROM lineitem GROUP BY ALL)
SELECT warehouse_id, {sql.stamp('l_shipdate')} AS change_ts, total_qty, total_reserved, bronze_offset, {_TURNOVER} FROM t
"""


@query("stock_batch_totals", _BATCH_SQL)
def stock_batch_totals(spark, sf_dir):
    return stock.batch_totals(_stock_rows(spark, sf_dir)).withColumn("change_ts", stamp(F.col("change_ts")))


@query(
    "stock_running_total",
    f"""
WITH {sql.STOCK_STEPS}, totals AS (
  SELECT *, cast(sum(qty_step) OVER w AS bigint) AS total_qty, cast(sum(reserved_step) OVER w AS bigint) AS total_reserved FROM steps
  WINDOW w AS (PARTITION BY warehouse_id ORDER BY change_ts, lsn, bronze_partition, bronze_offset, product_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT warehouse_id, product_id, {sql.stamp('change_ts')} AS change_ts, bronze_offset, qty, total_qty, total_reserved, {_TURNOVER} FROM totals
""",
)
def stock_running_total(spark, sf_dir):
    totals = stock.running_totals(_stock_rows(spark, sf_dir))
    return totals.select(
        "warehouse_id", "product_id", stamp(F.col("change_ts")).alias("change_ts"), "bronze_offset", "qty",
        "total_qty", "total_reserved", "inventory_turnover",
    )


@query(
    "safe_ratio",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_linenumber - 1 <> 0 THEN l_quantity / (l_linenumber - 1)::double END AS ratio FROM lineitem
""",
)
def safe_ratio_(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        safe_ratio(F.col("l_quantity"), F.col("l_linenumber") - 1).alias("ratio"),
    )


@query(
    "enrich_latest_attributes",
    f"""
WITH t AS (SELECT l_suppkey, l_shipdate, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS total_qty FROM lineitem GROUP BY ALL)
SELECT cast(l_suppkey AS varchar) AS warehouse_id, {sql.stamp('l_shipdate')} AS change_ts, total_qty, s_name AS name, r_name AS region, n_name AS country
FROM t LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""",
)
def enrich_latest_attributes(spark, sf_dir):
    bronze = stand_ins.warehouse_changes(*_t(spark, sf_dir, "supplier", "nation", "region"))
    latest = latest_per_key(
        ops.decode_changes(bronze, CDC_TABLES["warehouses"]), ["warehouse_id"], ops.CHANGE_ORDER
    ).select("warehouse_id", "name", "region", "country")
    totals = stock.batch_totals(_stock_rows(spark, sf_dir)).select("warehouse_id", "change_ts", "total_qty")
    return totals.join(latest, "warehouse_id", "left").withColumn("change_ts", stamp(F.col("change_ts")))


# ---- order facts ---------------------------------------------------------------------


def _order_events(spark, sf_dir) -> DataFrame:
    return stand_ins.order_events(*_t(spark, sf_dir, "orders", "lineitem"))


_LIFECYCLE = """
ship AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_orderkey * 8 + l_linenumber DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1),
life AS (
  SELECT o_orderkey, o_custkey, cast(o_orderkey % 200 AS varchar) AS product_id, o_orderdate AS order_ts, o_totalprice AS order_amount, 'USD' AS order_currency,
    CASE WHEN o_orderstatus IN ('F', 'O') OR o_orderkey % 3 <> 0 THEN 'PAY-' || o_orderkey END AS payment_id,
    CASE WHEN o_orderstatus IN ('F', 'O') OR o_orderkey % 3 <> 0 THEN 'CARD' END AS payment_method,
    CASE WHEN o_orderstatus = 'F' THEN 'SETTLED' WHEN o_orderstatus = 'O' THEN 'PENDING' WHEN o_orderkey % 3 <> 0 THEN 'FAILED' END AS payment_status,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 HOUR WHEN o_orderstatus = 'O' OR o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 1 HOUR END AS payment_ts,
    CASE WHEN l_orderkey IS NOT NULL THEN 'SHP-' || l_orderkey || '-' || l_linenumber END AS shipment_id,
    l_returnflag AS shipment_carrier, l_linenumber AS shipment_eta_days, l_shipdate AS shipment_ts,
    o_custkey % 4 AS bronze_partition, o_orderkey AS bronze_offset
  FROM orders LEFT JOIN ship ON l_orderkey = o_orderkey)"""

_LIFE_COLUMNS = f"""cast(o_orderkey AS varchar) AS order_id, {sql.stamp('order_ts')} AS order_ts, order_amount, order_currency,
  payment_id, payment_method, payment_status, {sql.stamp('payment_ts')} AS payment_ts,
  shipment_id, shipment_carrier, shipment_eta_days, {sql.stamp('shipment_ts')} AS shipment_ts"""


def _shown_orders(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{c: stamp(F.col(c)) for c in ("order_ts", "payment_ts", "shipment_ts")},
            "order_amount": F.col("order_amount").cast("double"),
        }
    )


@query(
    "order_lifecycle",
    f"WITH {_LIFECYCLE} SELECT {_LIFE_COLUMNS}, cast(o_custkey AS varchar) AS user_id, product_id, bronze_partition, bronze_offset FROM life",
)
def order_lifecycle(spark, sf_dir):
    return _shown_orders(facts.order_lifecycle(_order_events(spark, sf_dir))).drop("order_date")


@query(
    "stream_order_lifecycle",
    f"WITH {_LIFECYCLE} SELECT {_LIFE_COLUMNS}, cast(o_custkey AS varchar) AS user_id, product_id, bronze_partition, bronze_offset FROM life",
)
def stream_order_lifecycle(spark, sf_dir):
    """Stream-stream joins over five parts in mixed order, plus corrections."""
    root = workspace.fresh_folder(spark, "order-stream")
    events = settle(_order_events(spark, sf_dir), "order-events", above=0)
    ends = events.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    if ends["a"] is None:
        return _shown_orders(facts.order_lifecycle(events)).drop("order_date")
    span = (ends["b"] - ends["a"]) / 5
    fifth = F.least(F.floor((F.unix_micros("event_time") - F.unix_micros(F.lit(ends["a"]))) / F.lit(max(span.total_seconds() * 1e6, 1.0))), F.lit(4))
    # as many files a fifth as keep each of them a task's size; a batch takes the files of one fifth
    each = max(1, -(-input_bytes(events) // (5 * ONE_TASK_BYTES)))
    for part in (1, 0, 3, 2, 4):
        events.filter(fifth == part).repartition(each).write.mode("append").parquet(f"{root}/in")
    stream, single = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", most).parquet(f"{root}/in") for most in (each, 1)
    )
    # a fifth of few rows may have fewer files: batches then mix fifths, and lateness is judged file by file
    fine = None if list_files(spark, f"{root}/in").count() == 5 * each else single
    bounds = lifecycle.Bounds(lateness="30 days", before="30 days", after="120 days")
    queries = lifecycle.start_lifecycle(stream, f"{root}/out", f"{root}/checkpoint", bounds, fine)
    for started in queries.values():
        started.awaitTermination()
    mark = lifecycle.watermark_of([queries[name] for name in lifecycle.MATCHED])
    streamed, corrections = lifecycle.corrected_lifecycle(spark, f"{root}/out", events, mark, bounds)
    return _shown_orders(streamed.unionByName(corrections)).drop("order_date")


def _with_versions(fact: DataFrame, *prefixes: str) -> DataFrame:
    """Replace surrogate keys by the key and start of the version they stand for, which the fact names beside them."""
    starts = [f"{prefix}_valid_from" for prefix in prefixes]
    return fact.withColumns({c: stamp(F.col(c)) for c in starts}).drop(*[f"{prefix}_sk" for prefix in prefixes])


def _with_date(fact: DataFrame, dates: DataFrame) -> DataFrame:
    days = F.broadcast(dates.select("date_sk", F.col("date_key").cast("string").alias("date_key")))
    return fact.join(days, "date_sk", "left").drop("date_sk", "processed_at")


@query(
    "fact_order_service",
    f"""
WITH {sql.CUSTOMER_HISTORY}, {sql.PRODUCT_HISTORY}, {_LIFECYCLE}
SELECT {_LIFE_COLUMNS}, life.bronze_partition AS bronze_partition, life.bronze_offset AS bronze_offset,
       strftime(order_ts, '%Y-%m-%d') AS date_key, c.user_id AS customer_nk, {sql.stamp('c.valid_from')} AS customer_valid_from,
       p.product_id AS product_nk, {sql.stamp('p.valid_from')} AS product_valid_from
FROM life
LEFT JOIN c ON c.user_id = cast(o_custkey AS varchar) AND order_ts >= c.valid_from AND order_ts < coalesce(c.valid_to, TIMESTAMP '2999-12-31')
LEFT JOIN p ON p.product_id = life.product_id AND order_ts >= p.valid_from AND order_ts < coalesce(p.valid_to, TIMESTAMP '2999-12-31')
""",
)
def fact_order_service(spark, sf_dir):
    who, what, when = _staged(spark, sf_dir, customers, products, calendar)
    fact = facts.fact_order_service(_order_events(spark, sf_dir), who, what, when, name_versions=True)
    shown = _with_date(_with_versions(fact, "customer", "product"), when)
    return _shown_orders(shown).drop("order_sk")


@query(
    "order_funnel_rates",
    f"""
WITH {_LIFECYCLE}, counted AS (
  SELECT year(order_ts) AS year, count(*) AS orders, count(payment_id) AS paid_orders,
    count(*) FILTER (payment_id IS NOT NULL AND shipment_id IS NOT NULL) AS shipped_orders,
    count(*) FILTER (payment_status = 'SETTLED') AS settled_orders FROM life GROUP BY 1)
SELECT *, paid_orders::double / orders::double AS payment_rate, shipped_orders::double / paid_orders::double AS shipment_rate FROM counted
""",
)
def order_funnel_rates(spark, sf_dir):
    orders = facts.order_lifecycle(_order_events(spark, sf_dir)).withColumn("year", F.year("order_ts"))
    return gold.funnel_rates(orders, ["year"])


# ---- inventory facts -----------------------------------------------------------------


def _inventory_events(spark, sf_dir) -> DataFrame:
    return stand_ins.inventory_events(table(spark, sf_dir, "lineitem"))


_MOVES = """
moves AS (SELECT cast(l_suppkey AS varchar) AS warehouse_id, cast(l_partkey AS varchar) AS product_id,
  CASE WHEN l_returnflag = 'R' THEN 'RETURN' ELSE 'SALE' END AS change_type,
  CASE WHEN l_returnflag = 'R' THEN cast(l_quantity AS integer) ELSE -cast(l_quantity AS integer) END AS quantity_delta,
  l_linenumber * 10 AS previous_qty,
  greatest(0, l_linenumber * 10 + CASE WHEN l_returnflag = 'R' THEN cast(l_quantity AS integer) ELSE -cast(l_quantity AS integer) END)
    + CASE WHEN l_orderkey % 89 = 0 THEN 1 ELSE 0 END AS new_qty,
  l_linestatus AS reason, cast(l_orderkey AS varchar) AS order_id, l_shipdate AS change_ts,
  l_partkey AS bronze_partition, l_orderkey * 8 + l_linenumber AS bronze_offset FROM lineitem)"""


@query(
    "fact_inventory_position",
    f"""
WITH {sql.WAREHOUSE_HISTORY}, {sql.PRODUCT_HISTORY}, {_MOVES}, levels AS (
  SELECT *, cast(sum(quantity_delta) OVER (PARTITION BY warehouse_id ORDER BY change_ts, bronze_partition, bronze_offset
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS running_level FROM moves)
SELECT change_type, quantity_delta, new_qty, reason, order_id, {sql.stamp('m.change_ts')} AS change_ts,
       m.bronze_partition AS bronze_partition, m.bronze_offset AS bronze_offset,
       strftime(m.change_ts, '%Y-%m-%d') AS date_key, w.warehouse_id AS warehouse_nk, {sql.stamp('w.valid_from')} AS warehouse_valid_from,
       p.product_id AS product_nk, {sql.stamp('p.valid_from')} AS product_valid_from, running_level
FROM levels m
LEFT JOIN w ON w.warehouse_id = m.warehouse_id AND m.change_ts >= w.valid_from AND m.change_ts < coalesce(w.valid_to, TIMESTAMP '2999-12-31')
LEFT JOIN p ON p.product_id = m.product_id AND m.change_ts >= p.valid_from AND m.change_ts < coalesce(p.valid_to, TIMESTAMP '2999-12-31')
""",
)
def fact_inventory_position(spark, sf_dir):
    where, what, when = _staged(spark, sf_dir, warehouses, products, calendar)
    fact = facts.fact_inventory_position(_inventory_events(spark, sf_dir), where, what, when, name_versions=True)
    shown = _with_date(_with_versions(fact, "warehouse", "product"), when).drop("inventory_sk")
    order = ["change_ts", "bronze_partition", "bronze_offset"]
    shown, timeline = settled(shown, ["warehouse_nk"], order)
    levels = timeline.extend(timeline.attach(shown), running={"running_level": F.col("quantity_delta")})
    return timeline.detach(levels).withColumn("change_ts", stamp(F.col("change_ts")))


_RECONCILED = f"""
WITH {_MOVES}, checked AS (
  SELECT *, new_qty IS DISTINCT FROM greatest(0, previous_qty + quantity_delta) AS breaks_rule,
    lag(new_qty) OVER w AS last_qty, row_number() OVER w > 1 AS had FROM moves
  WINDOW w AS (PARTITION BY warehouse_id, product_id ORDER BY change_ts, bronze_partition, bronze_offset))
SELECT warehouse_id, count(*) AS changes, count(*) FILTER (breaks_rule) AS rule_breaks,
       count(*) FILTER (had AND previous_qty IS DISTINCT FROM last_qty) AS chain_breaks FROM checked GROUP BY 1
"""


@query("stock_reconcile", _RECONCILED)
def stock_reconcile(spark, sf_dir):
    rows = topic_rows(_inventory_events(spark, sf_dir), "inventory-changes.v1").withColumnRenamed("ts", "change_ts")
    checked = quality.reconcile_stock(
        rows, ["warehouse_id", "product_id"], ["change_ts", "bronze_partition", "bronze_offset"]
    )
    return checked.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if("breaks_rule").alias("rule_breaks"),
        F.count_if("breaks_chain").alias("chain_breaks"),
    )


@query(
    "gold_inventory_health",
    f"""
WITH {_MOVES}
SELECT warehouse_id, count(*) AS changes, cast(sum(new_qty) AS bigint)::double / count(new_qty)::double AS avg_level,
       cast(sum(quantity_delta) AS bigint) AS net_change, cast(min(new_qty) AS bigint) AS lowest_level, min(new_qty) < 5 AS runs_low
FROM moves GROUP BY 1
""",
)
def gold_inventory_health(spark, sf_dir):
    rows = topic_rows(_inventory_events(spark, sf_dir), "inventory-changes.v1")
    return gold.inventory_health(rows, "warehouse_id", "new_qty", "quantity_delta", 5)


# ---- engagement facts ----------------------------------------------------------------


def _interactions(spark, sf_dir) -> DataFrame:
    return stand_ins.interaction_events(table(spark, sf_dir, "events"))


_TOUCHES = """
touches AS (SELECT cast(event_id AS varchar) AS interaction_id, cast(user_id AS varchar) AS user_id,
  json_extract_string(props, '$.k') AS product_id, ts,
  CASE event_type WHEN 'purchase' THEN 'CART_ADD' WHEN 'error' THEN 'CART_REMOVE' WHEN 'signup' THEN 'REVIEW' ELSE 'PAGE_VIEW' END AS interaction_type,
  cast(floor(value * 100) AS bigint) AS duration_ms, event_id % 3 AS bronze_partition, event_id // 3 AS bronze_offset
  FROM events WHERE event_type <> 'click')"""

_DAILY = """
daily AS (SELECT user_id, product_id, cast(ts AS date) AS event_date, count(DISTINCT interaction_id) AS interactions,
  count(*) FILTER (interaction_type = 'CART_ADD') AS cart_adds, count(*) FILTER (interaction_type = 'CART_REMOVE') AS cart_removes,
  count(*) FILTER (interaction_type = 'REVIEW') AS reviews, cast(sum(duration_ms) AS bigint) AS total_duration_ms,
  max(ts) AS last_interaction_ts, arg_max(bronze_partition, ts) AS latest_bronze_partition, arg_max(bronze_offset, ts) AS latest_bronze_offset
  FROM touches GROUP BY 1, 2, 3)"""

_DAILY_COLUMNS = f"""interactions, cart_adds, cart_removes, reviews, total_duration_ms,
  {sql.stamp('last_interaction_ts')} AS last_interaction_ts, latest_bronze_partition, latest_bronze_offset"""


@query(
    "engagement_valid_rows",
    f"WITH {_TOUCHES} SELECT interaction_id, user_id, product_id, interaction_type, duration_ms, {sql.stamp('ts')} AS interaction_ts FROM touches",
)
def engagement_valid_rows(spark, sf_dir):
    return facts.valid_interactions(_interactions(spark, sf_dir)).select(
        "interaction_id", "user_id", "product_id", "interaction_type", "duration_ms", stamp(F.col("ts")).alias("interaction_ts")
    )


@query("engagement_dropped_rows", "SELECT 'SEARCH' AS interaction_type, count(*) AS dropped FROM events WHERE event_type = 'click'")
def engagement_dropped_rows(spark, sf_dir):
    return facts.dropped_interactions(_interactions(spark, sf_dir))


@query(
    "engagement_daily",
    f"WITH {_TOUCHES}, {_DAILY} SELECT user_id, product_id, cast(event_date AS varchar) AS event_date, {_DAILY_COLUMNS} FROM daily",
)
def engagement_daily(spark, sf_dir):
    daily = facts.engagement_by_day(_interactions(spark, sf_dir)).drop("latest_context")
    return daily.withColumns(
        {"event_date": F.col("event_date").cast("string"), "last_interaction_ts": stamp(F.col("last_interaction_ts"))}
    )


@query(
    "latest_context",
    f"""
WITH {_TOUCHES}
SELECT user_id, product_id, {sql.stamp('max(ts)')} AS latest_ts, arg_max(bronze_partition, ts) AS latest_partition,
       arg_max(bronze_offset, ts) AS latest_offset
FROM touches GROUP BY 1, 2
""",
)
def latest_context(spark, sf_dir):
    context = F.max(F.struct("ts", "bronze_partition", "bronze_offset")).alias("c")
    return facts.valid_interactions(_interactions(spark, sf_dir)).groupBy("user_id", "product_id").agg(context).select(
        "user_id", "product_id", stamp(F.col("c.ts")).alias("latest_ts"),
        F.col("c.bronze_partition").alias("latest_partition"), F.col("c.bronze_offset").alias("latest_offset"),
    )


@query(
    "fact_customer_engagement",
    f"""
WITH {sql.CUSTOMER_HISTORY}, {sql.PRODUCT_HISTORY}, {_TOUCHES}, {_DAILY}
SELECT {_DAILY_COLUMNS}, cast(event_date AS varchar) AS date_key, c.user_id AS customer_nk, {sql.stamp('c.valid_from')} AS customer_valid_from,
       p.product_id AS product_nk, {sql.stamp('p.valid_from')} AS product_valid_from
FROM daily d
LEFT JOIN c ON c.user_id = d.user_id AND last_interaction_ts >= c.valid_from AND last_interaction_ts < coalesce(c.valid_to, TIMESTAMP '2999-12-31')
LEFT JOIN p ON p.product_id = d.product_id AND last_interaction_ts >= p.valid_from AND last_interaction_ts < coalesce(p.valid_to, TIMESTAMP '2999-12-31')
""",
)
def fact_customer_engagement(spark, sf_dir):
    who, what, when = _staged(spark, sf_dir, customers, products, calendar)
    fact = facts.fact_customer_engagement(_interactions(spark, sf_dir), who, what, when, name_versions=True)
    shown = _with_date(_with_versions(fact, "customer", "product"), when).drop("engagement_sk")
    return shown.withColumn("last_interaction_ts", stamp(F.col("last_interaction_ts")))


# ---- star ----------------------------------------------------------------------------


@query(
    "star_row_counts",
    f"""
WITH {sql.CUSTOMER_HISTORY}, {sql.PRODUCT_HISTORY}, {sql.WAREHOUSE_HISTORY}, {_SUPPLIERS},
{sql.history('sup', 's', ['supplier_id'], sql.CHANGE_ORDER, ['name', 'country', 'rating'], 'is_delete')}, {_TOUCHES}, {_DAILY}
SELECT 'dim_customer_profile' AS table_name, count(*) AS rows FROM c
UNION ALL SELECT 'dim_product_catalog', count(*) FROM p
UNION ALL SELECT 'dim_warehouse', count(*) FROM w
UNION ALL SELECT 'dim_supplier', count(*) FROM s
UNION ALL SELECT 'dim_date', date_diff('day', date_trunc('year', (SELECT min(o_orderdate) FROM orders)), date_trunc('year', (SELECT max(ts) FROM events)) + INTERVAL 1 YEAR)
UNION ALL SELECT 'fact_order_service', count(*) FROM orders
UNION ALL SELECT 'fact_inventory_position', count(*) FROM lineitem
UNION ALL SELECT 'fact_customer_engagement', count(*) FROM daily
""",
)
def star_row_counts(spark, sf_dir):
    built = star.build_star(
        spark, stand_ins.star_inputs(spark, sf_dir), workspace.fresh_folder(spark, "star"), run_ts=F.lit("2025-01-01").cast("timestamp")
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in built.items()
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total


# ---- quality -------------------------------------------------------------------------


@query(
    "pk_violations",
    """
SELECT l_orderkey, l_linenumber, count(*) AS rows, false AS has_null FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""",
)
def pk_violations(spark, sf_dir):
    return quality.key_faults(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "quality_split",
    """
WITH r AS (SELECT concat_ws(',', CASE WHEN o_orderkey % 101 = 0 THEN 'amount_missing' END,
  CASE WHEN o_orderkey % 103 = 0 THEN 'unknown_status' END, CASE WHEN o_orderkey % 107 = 0 THEN 'customer_missing' END) AS failed_rules FROM orders)
SELECT failed_rules, failed_rules = '' AS is_good, count(*) AS rows FROM r GROUP BY ALL
""",
)
def quality_split(spark, sf_dir):
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 101 != 0, F.col("o_totalprice")).alias("amount"),
        F.when(key % 103 == 0, "UNKNOWN").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(key % 107 != 0, F.col("o_custkey")).alias("customer"),
    )
    checked = quality.check_rules(
        orders,
        {
            "amount_missing": F.col("amount").isNull(),
            "unknown_status": ~F.col("status").isin("F", "O", "P"),
            "customer_missing": F.col("customer").isNull(),
        },
    )
    return checked.groupBy(F.concat_ws(",", "failed_rules").alias("failed_rules")).agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("is_good", F.col("failed_rules") == "")


# ---- gold ----------------------------------------------------------------------------


@query(
    "gold_revenue_cadence",
    """
SELECT strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS period_start, c_mktsegment AS segment, count(*) AS orders,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""",
)
def gold_revenue_cadence(spark, sf_dir):
    orders, customer = _t(spark, sf_dir, "orders", "customer")
    sales = orders.join(
        customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey"
    )
    cadence = gold.revenue_cadence(sales, "o_orderdate", "o_totalprice", ["segment"], "week")
    return cadence.withColumn("period_start", F.col("period_start").cast("string"))


@query(
    "gold_revenue_by_supplier",
    """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS period_start, s_name AS supplier, count(*) AS orders,
       cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS revenue
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
""",
)
def gold_revenue_by_supplier(spark, sf_dir):
    lineitem, supplier = _t(spark, sf_dir, "lineitem", "supplier")
    # summed by key first: the name is looked up for one row per day and supplier
    daily = gold.revenue_cadence(lineitem, "l_shipdate", "l_extendedprice", ["l_suppkey"], "day")
    named = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier"))
    return daily.join(named, "l_suppkey", "left").select(
        F.col("period_start").cast("string").alias("period_start"), "supplier", "orders", "revenue"
    )


@query(
    "gold_retention_funnel",
    """
WITH u AS (SELECT user_id, date_trunc('day', min(ts)) AS cohort, bool_or(event_type = 'view') AS e, bool_or(event_type = 'purchase') AS p FROM events GROUP BY 1),
c AS (SELECT strftime(cohort, '%Y-%m-%d') AS cohort, count(*) AS users, count(*) FILTER (e) AS engaged_users, count(*) FILTER (e AND p) AS converted_users FROM u GROUP BY 1)
SELECT *, CASE WHEN engaged_users > 0 THEN converted_users::double / engaged_users::double END AS conversion_rate FROM c
""",
)
def gold_retention_funnel(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    funnel = gold.cohort_conversion(
        events, "user_id", "ts", F.col("event_type") == "view", F.col("event_type") == "purchase", grain="day"
    )
    return funnel.withColumn("cohort", F.col("cohort").cast("string"))


@query(
    "gold_supplier_scorecard",
    """
WITH d AS (SELECT l_suppkey, count(*) AS shipments,
    count(*) FILTER (l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 90 DAY) AS on_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT s_suppkey, s_acctbal AS rating, coalesce(shipments, 0) AS shipments, coalesce(on_time, 0) AS on_time,
       CASE WHEN shipments > 0 THEN on_time::double / shipments::double END AS on_time_share
FROM supplier LEFT JOIN d ON s_suppkey = l_suppkey
""",
)
def gold_supplier_scorecard(spark, sf_dir):
    lineitem, orders, supplier = _t(spark, sf_dir, "lineitem", "orders", "supplier")
    shipped = lineitem.select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"), "l_shipdate").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
    )
    on_time = (F.col("l_shipdate") >= F.col("o_orderdate")) & (
        F.col("l_shipdate") <= F.timestamp_add("DAY", F.lit(90), F.col("o_orderdate"))
    )
    rated = supplier.select("s_suppkey", F.col("s_acctbal").alias("rating"))
    return gold.supplier_scorecard(shipped, rated, "s_suppkey", on_time)


@query(
    "gold_customer_ltv",
    """
WITH spent AS (SELECT o_custkey, count(*) AS orders, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS ordered_value FROM orders GROUP BY 1)
SELECT c_custkey, c_acctbal AS recorded_value, coalesce(orders, 0) AS orders, coalesce(ordered_value, 0.0) AS ordered_value,
       CASE WHEN c_acctbal <> 0 THEN coalesce(ordered_value, 0.0) / c_acctbal END AS value_ratio
FROM customer LEFT JOIN spent ON c_custkey = o_custkey
""",
)
def gold_customer_ltv(spark, sf_dir):
    orders, customer = _t(spark, sf_dir, "orders", "customer")
    known = customer.select("c_custkey", F.col("c_acctbal").alias("recorded_value"))
    return gold.customer_value(
        orders.withColumnRenamed("o_custkey", "c_custkey"), known, "c_custkey", "o_totalprice", "recorded_value"
    )


@query(
    "gold_value_at_order_time",
    f"""
WITH {sql.CUSTOMER_HISTORY}
SELECT c.segment AS segment, count(*) AS orders, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS ordered_value,
       cast(sum(cast(c.lifetime_value AS decimal(18,2))) AS double) AS recorded_value
FROM orders LEFT JOIN c ON c.user_id = cast(o_custkey AS varchar) AND o_orderdate >= c.valid_from
  AND o_orderdate < coalesce(c.valid_to, TIMESTAMP '2999-12-31')
GROUP BY 1
""",
)
def gold_value_at_order_time(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), "o_orderdate", "o_totalprice"
    )
    recorded = asof_join(
        orders, customers(spark, sf_dir), {"user_id": "user_id"}, "o_orderdate",
        {"segment": "segment", "lifetime_value": "lifetime_value"},
    )
    return recorded.groupBy("segment").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("ordered_value"),
        F.sum(F.col("lifetime_value").cast("decimal(18,2)")).cast("double").alias("recorded_value"),
    )
