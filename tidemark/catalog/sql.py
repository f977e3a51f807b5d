"""Pieces of comparison SQL that several queries share."""

from __future__ import annotations

from collections.abc import Sequence


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def history(
    source: str, name: str, keys: Sequence[str], order: Sequence[str], state: Sequence[str], deleted: str | None = None
) -> str:
    """Common table expressions that turn the change table ``source`` into versions ``name``."""
    key, total = ", ".join(keys), ", ".join(order)
    compared = [*state, deleted] if deleted else list(state)
    lags = ", ".join(f"lag({c}) OVER w AS _p_{c}" for c in compared)
    differs = " OR ".join(f"{c} IS DISTINCT FROM _p_{c}" for c in compared)
    live = f"WHERE NOT {deleted}" if deleted else ""
    return f"""
{name}_1 AS (SELECT *, lead({order[0]}) OVER (PARTITION BY {key} ORDER BY {total}) AS _next FROM {source}),
{name}_2 AS (SELECT * FROM {name}_1 WHERE _next IS DISTINCT FROM {order[0]}),
{name}_3 AS (SELECT *, row_number() OVER w AS _rn, {lags} FROM {name}_2 WINDOW w AS (PARTITION BY {key} ORDER BY {total})),
{name}_4 AS (SELECT * FROM {name}_3 WHERE _rn = 1 OR {differs}),
{name}_5 AS (SELECT *, lead({order[0]}) OVER (PARTITION BY {key} ORDER BY {total}) AS _end FROM {name}_4),
{name} AS (SELECT *, {order[0]} AS valid_from, _end AS valid_to, _end IS NULL AS is_current FROM {name}_5 {live})"""


# Change tables equal to the feeds of stand_ins, from the plain columns.
SEGMENTS = """
segments AS (SELECT cast(o_custkey AS varchar) AS user_id, o_orderpriority AS segment, o_totalprice AS lifetime_value,
  o_orderdate AS change_ts, o_orderkey AS lsn, o_custkey % 4 AS bronze_partition, o_orderkey AS bronze_offset,
  o_orderkey % 41 = 0 AS is_delete FROM orders)"""

PRODUCTS = """
products AS (
  SELECT cast(k AS varchar) AS product_id, 'Part#' || k AS title, 'Group#' || (k % 25) AS category, price_usd, change_ts, lsn,
    bronze_partition, bronze_offset
  FROM (
    SELECT p_partkey AS k, p_retailprice AS price_usd, TIMESTAMP '1995-01-01' AS change_ts, -1::bigint AS lsn,
      0 AS bronze_partition, p_partkey AS bronze_offset FROM part
    UNION ALL
    SELECT l_partkey, floor(l_extendedprice / l_quantity), l_shipdate, l_orderkey, l_suppkey, l_orderkey * 8 + l_linenumber
    FROM lineitem))"""

STOCK = """
stock AS (SELECT cast(l_suppkey AS varchar) AS warehouse_id, cast(l_partkey AS varchar) AS product_id,
  cast(l_quantity AS bigint) AS qty, cast(l_linenumber AS bigint) AS reserved_qty, l_shipdate AS change_ts,
  l_orderkey AS lsn, l_partkey AS bronze_partition, l_orderkey * 8 + l_linenumber AS bronze_offset FROM lineitem)"""

STOCK_STEPS = STOCK + """,
steps AS (SELECT *, qty - coalesce(lag(qty) OVER p, 0) AS qty_step,
  reserved_qty - coalesce(lag(reserved_qty) OVER p, 0) AS reserved_step FROM stock
  WINDOW p AS (PARTITION BY warehouse_id, product_id ORDER BY change_ts, lsn, bronze_partition, bronze_offset))"""

CHANGE_ORDER = ("change_ts", "lsn", "bronze_partition", "bronze_offset")

SEGMENT_HISTORY = SEGMENTS + "," + history("segments", "h", ["user_id"], CHANGE_ORDER, ["segment"])
PRODUCT_HISTORY = PRODUCTS + "," + history(
    "products", "p", ["product_id"], CHANGE_ORDER, ["title", "category", "price_usd"]
)

# Users and segments merged along time, filled forward; users are never deleted here.
CUSTOMER_FEED = SEGMENTS + """,
users AS (SELECT cast(c_custkey AS varchar) AS user_id, c_name AS email, n_name AS country,
  TIMESTAMP '1995-01-01' AS change_ts, c_custkey AS lsn, 0 AS bronze_partition, c_custkey AS bronze_offset
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
both_feeds AS (
  SELECT user_id, email, country, NULL AS segment, NULL::double AS lifetime_value, change_ts, lsn, bronze_partition,
    bronze_offset, 'users' AS feed, NULL AS seg_row FROM users
  UNION ALL
  SELECT user_id, NULL, NULL, CASE WHEN NOT is_delete THEN segment END, CASE WHEN NOT is_delete THEN lifetime_value END,
    change_ts, lsn, bronze_partition, bronze_offset, 'customer_segments', lsn FROM segments),
numbered AS (SELECT *, count(seg_row) OVER w AS seg_no, count(email) OVER w AS user_no FROM both_feeds
  WINDOW w AS (PARTITION BY user_id ORDER BY change_ts, lsn, bronze_partition, bronze_offset, feed
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (SELECT user_id, change_ts, lsn, bronze_partition, bronze_offset, feed,
    max(email) OVER (PARTITION BY user_id, user_no) AS email, max(country) OVER (PARTITION BY user_id, user_no) AS country,
    max(segment) OVER (PARTITION BY user_id, seg_no) AS segment,
    max(lifetime_value) OVER (PARTITION BY user_id, seg_no) AS lifetime_value,
    list_aggregate(list_sort(list_distinct(list(feed) OVER (PARTITION BY user_id, change_ts))), 'string_agg', ',') AS change_source
  FROM numbered)"""

CUSTOMER_HISTORY = CUSTOMER_FEED + "," + history(
    "filled", "c", ["user_id"], [*CHANGE_ORDER, "feed"], ["email", "country", "segment", "lifetime_value"]
)

WAREHOUSE_HISTORY = STOCK_STEPS + """,
wh_feed AS (
  SELECT warehouse_id, change_ts, lsn, bronze_partition, bronze_offset, 'warehouse_inventory' AS feed, product_id,
    qty_step, reserved_step FROM steps
  UNION ALL
  SELECT cast(s_suppkey AS varchar), TIMESTAMP '1995-01-01', s_suppkey, 0, s_suppkey, 'warehouses', NULL, NULL, NULL FROM supplier),
wh_rows AS (SELECT f.*, s_name AS name, r_name AS region, n_name AS country,
    cast(sum(qty_step) OVER w AS bigint) AS total_qty, cast(sum(reserved_step) OVER w AS bigint) AS total_reserved
  FROM wh_feed f JOIN supplier ON s_suppkey = cast(warehouse_id AS bigint)
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WINDOW w AS (PARTITION BY warehouse_id ORDER BY change_ts, lsn, bronze_partition, bronze_offset, feed, product_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),""" + history(
    "wh_rows", "w", ["warehouse_id"], [*CHANGE_ORDER, "feed", "product_id"], ["name", "region", "country", "total_qty", "total_reserved"]
)
