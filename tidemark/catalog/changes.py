"""Registered queries: change decoding, history, as-of joins, state over time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark import workspace
from tidemark.catalog import sql, stand_ins
from tidemark.catalog.registry import query
from tidemark.catalog.stand_ins import table
from tidemark.functions.casts import stamp
from tidemark.functions.keys import state_fingerprint, surrogate_key
from tidemark.operators import changes as ops
from tidemark.operators import snapshots
from tidemark.operators.asof import asof_join, unmatched_rows
from tidemark.operators.digests import difference_by_digests
from tidemark.operators.feeds import combine_feeds, consolidate, forward_fill
from tidemark.operators.history import build_history, current_versions, detect_changes, range_faults
from tidemark.operators.kept_history import bucket_of, merge_history, read_history
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.settle import settle
from tidemark.operators.timeline import settled
from tidemark.schemas import CDC_TABLES
from tidemark.sources import topics
from tidemark.sources.files import list_files
from tidemark.streaming.upserts import current_rows, start_upsert


def segment_rows(spark, sf_dir) -> DataFrame:
    """Decoded segment changes: one per order, deletes at every 41st key."""
    bronze = stand_ins.segment_changes(table(spark, sf_dir, "orders"))
    return ops.require_columns(ops.decode_changes(bronze, CDC_TABLES["customer_segments"]), "user_id")


def shown_range(history: DataFrame) -> DataFrame:
    """Open ends as NULL, times as text."""
    return history.withColumns(
        {
            "valid_from": stamp(F.col("valid_from")),
            "valid_to": F.when(~F.col("is_current"), stamp(F.col("valid_to"))),
        }
    )


@query(
    "cdc_flatten_row",
    f"""
SELECT cast(o_custkey AS varchar) AS user_id, o_orderpriority AS segment, o_totalprice AS lifetime_value,
       CASE WHEN o_orderkey % 41 = 0 THEN 'd' ELSE 'u' END AS op, {sql.stamp('o_orderdate')} AS change_ts,
       o_orderkey AS lsn, o_custkey % 4 AS bronze_partition, o_orderkey AS bronze_offset
FROM orders
""",
)
def cdc_flatten_row(spark, sf_dir):
    return segment_rows(spark, sf_dir).select(
        "user_id", "segment", "lifetime_value", "op", stamp(F.col("change_ts")).alias("change_ts"),
        "lsn", "bronze_partition", "bronze_offset",
    )


def segment_history(spark, sf_dir, deletes: bool = False) -> DataFrame:
    return build_history(
        segment_rows(spark, sf_dir), ["user_id"], ops.CHANGE_ORDER, ["segment"], "is_delete" if deletes else None
    )


_HISTORY_COLUMNS = f"user_id, segment, {sql.stamp('valid_from')} AS valid_from, {sql.stamp('valid_to')} AS valid_to, is_current, bronze_offset"


@query("scd2_history", f"WITH {sql.SEGMENT_HISTORY} SELECT {_HISTORY_COLUMNS} FROM h")
def scd2_history(spark, sf_dir):
    return shown_range(segment_history(spark, sf_dir)).select(
        "user_id", "segment", "valid_from", "valid_to", "is_current", "bronze_offset"
    )


@query(
    "scd2_current",
    f"WITH {sql.SEGMENT_HISTORY} SELECT user_id, segment, {sql.stamp('valid_from')} AS valid_from FROM h WHERE is_current",
)
def scd2_current(spark, sf_dir):
    current = current_versions(segment_history(spark, sf_dir))
    return current.select("user_id", "segment", stamp(F.col("valid_from")).alias("valid_from"))


_DELETE_HISTORY = sql.SEGMENTS + "," + sql.history("segments", "h", ["user_id"], sql.CHANGE_ORDER, ["segment"], "is_delete")


@query("scd2_with_deletes", f"WITH {_DELETE_HISTORY} SELECT {_HISTORY_COLUMNS} FROM h")
def scd2_with_deletes(spark, sf_dir):
    return shown_range(segment_history(spark, sf_dir, deletes=True)).select(
        "user_id", "segment", "valid_from", "valid_to", "is_current", "bronze_offset"
    )


@query("scd2_incremental", f"WITH {_DELETE_HISTORY} SELECT {_HISTORY_COLUMNS}, true AS others_untouched FROM h")
def scd2_incremental(spark, sf_dir):
    """The history again, merged from batches: later changes first, then late ones, then one bucket's once more."""
    path = workspace.fresh_folder(spark, "kept-history")
    rows = settle(segment_rows(spark, sf_dir), "segment-rows")  # four batches read them
    by = (["user_id"], ops.CHANGE_ORDER, ["segment"], "is_delete", 16)
    early = F.col("change_ts") < F.lit("1998-06-01").cast("timestamp")
    third = F.pmod(F.col("lsn"), F.lit(3))
    merge_history(rows.filter(~early), path, *by)
    merge_history(rows.filter(early & (third == 0)), path, *by)
    merge_history(rows.filter(early & (third != 0)), path, *by)
    before = {r.path for r in list_files(spark, path).collect()}
    rewritten = merge_history(rows.filter(bucket_of(["user_id"], 16) == 5), path, *by)
    kept = {r.path for r in list_files(spark, path).collect()}
    untouched = rewritten == [5] and all("_bucket=5/" in p for p in before ^ kept)
    history = read_history(spark, path, rows.schema, "is_delete")
    return shown_range(history).select(
        "user_id", "segment", "valid_from", "valid_to", "is_current", "bronze_offset", F.lit(untouched).alias("others_untouched")
    )


@query(
    "change_detect",
    f"""
WITH {sql.SEGMENTS}, seen AS (SELECT *, row_number() OVER w AS rn, lag(segment) OVER w AS before FROM segments
  WINDOW w AS (PARTITION BY user_id ORDER BY change_ts, lsn, bronze_partition, bronze_offset))
SELECT user_id, segment, {sql.stamp('change_ts')} AS change_ts, bronze_offset FROM seen
WHERE rn = 1 OR segment IS DISTINCT FROM before
""",
)
def change_detect(spark, sf_dir):
    rows, timeline = settled(segment_rows(spark, sf_dir), ["user_id"], ops.CHANGE_ORDER)
    changed = timeline.detach(detect_changes(rows, ["user_id"], ops.CHANGE_ORDER, ["segment"], timeline))
    return changed.select("user_id", "segment", stamp(F.col("change_ts")).alias("change_ts"), "bronze_offset")


@query(
    "scd2_overlap_check",
    f"""
WITH {_DELETE_HISTORY}, stepped AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS next_from FROM h),
faults AS (SELECT CASE WHEN valid_to <= valid_from THEN 'empty' WHEN next_from < coalesce(valid_to, TIMESTAMP '2999-12-31') THEN 'overlap'
    WHEN next_from > valid_to THEN 'gap' END AS fault, user_id FROM stepped)
SELECT fault, count(*) AS versions, count(DISTINCT user_id) AS users FROM faults WHERE fault IS NOT NULL GROUP BY 1
""",
)
def scd2_overlap_check(spark, sf_dir):
    faults = range_faults(segment_history(spark, sf_dir, deletes=True), ["user_id"])
    return faults.groupBy("fault").agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("user_id").alias("users")
    )


@query(
    "change_history",
    f"""
WITH {sql.SEGMENTS}
SELECT user_id, strftime(date_trunc('month', change_ts), '%Y-%m') AS batch, count(*) AS changes,
       count(*) FILTER (is_delete) AS deletes, {sql.stamp('min(change_ts)')} AS first_change, {sql.stamp('max(change_ts)')} AS last_change
FROM segments GROUP BY ALL
""",
)
def change_history(spark, sf_dir):
    summary = ops.change_summary(segment_rows(spark, sf_dir), ["user_id"], F.date_format("change_ts", "yyyy-MM"))
    return summary.withColumns(
        {"first_change": stamp(F.col("first_change")), "last_change": stamp(F.col("last_change"))}
    )


_STATE = """
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_ts DESC, lsn DESC) AS rn
  FROM segments WHERE change_ts <= TIMESTAMP '{at}') WHERE rn = 1 AND NOT is_delete)"""


def _state(spark, sf_dir, at: str) -> DataFrame:
    return ops.state_as_of(segment_rows(spark, sf_dir), ["user_id"], F.lit(at).cast("timestamp"))


@query(
    "state_as_of",
    f"WITH {sql.SEGMENTS}, {_STATE.format(name='s', at='1998-01-01')} SELECT user_id, segment, lifetime_value, {sql.stamp('change_ts')} AS change_ts FROM s",
)
def state_as_of(spark, sf_dir):
    state = _state(spark, sf_dir, "1998-01-01")
    return state.select("user_id", "segment", "lifetime_value", stamp(F.col("change_ts")).alias("change_ts"))


@query(
    "state_diff",
    f"""
WITH {sql.SEGMENTS}, {_STATE.format(name='a', at='1998-01-01')}, {_STATE.format(name='b', at='2000-01-01')}
SELECT coalesce(a.user_id, b.user_id) AS user_id,
       CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       a.segment AS old_segment, b.segment AS new_segment
FROM a FULL JOIN b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.segment IS DISTINCT FROM b.segment OR a.lifetime_value IS DISTINCT FROM b.lifetime_value
""",
)
def state_diff(spark, sf_dir):
    difference = ops.state_difference(
        _state(spark, sf_dir, "1998-01-01"), _state(spark, sf_dir, "2000-01-01"), ["user_id"], ["segment", "lifetime_value"]
    )
    return difference.select(
        "user_id", "change", F.col("old.segment").alias("old_segment"), F.col("new.segment").alias("new_segment")
    )


_DIFF_SQL = f"""
WITH {sql.SEGMENTS}, {_STATE.format(name='a', at='1998-01-01')}, {_STATE.format(name='b', at='2000-01-01')}
SELECT coalesce(a.user_id, b.user_id) AS user_id,
       CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       a.segment AS old_segment, b.segment AS new_segment
FROM a FULL JOIN b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.segment IS DISTINCT FROM b.segment OR a.lifetime_value IS DISTINCT FROM b.lifetime_value
"""


@query("state_diff_digest", _DIFF_SQL)
def state_diff_digest(spark, sf_dir):
    """The same difference, from digests of buckets."""
    states = [settle(_state(spark, sf_dir, at), "state", above=0) for at in ("1998-01-01", "2000-01-01")]
    difference = difference_by_digests(*states, ["user_id"], ["segment", "lifetime_value"])
    return difference.select(
        "user_id", "change", F.col("old.segment").alias("old_segment"), F.col("new.segment").alias("new_segment")
    )


@query(
    "state_as_of_snapshots",
    f"""
WITH {sql.SEGMENTS}, {_STATE.format(name='s', at='1998-01-01')}
SELECT user_id, segment, lifetime_value, {sql.stamp('change_ts')} AS change_ts FROM s
""",
)
def state_as_of_snapshots(spark, sf_dir):
    """State at a time from a state kept half a year before it, after late changes dropped others."""
    path = workspace.fresh_folder(spark, "snapshots")
    rows = segment_rows(spark, sf_dir)
    late = F.pmod(F.col("lsn"), F.lit(5)) == 0
    kept = datetime(1997, 7, 1)
    snapshots.append_changes(rows.filter(~late), path)
    for at in (datetime(1996, 1, 1), kept):
        snapshots.keep_state(spark, path, rows.schema, ["user_id"], at)
    snapshots.append_changes(rows.filter(late), path)
    snapshots.keep_state(spark, path, rows.schema, ["user_id"], kept)
    state = snapshots.state_at(spark, path, rows.schema, ["user_id"], datetime(1998, 1, 1))
    return state.select("user_id", "segment", "lifetime_value", stamp(F.col("change_ts")).alias("change_ts"))


@query(
    "latest_per_key",
    f"""
SELECT * EXCLUDE rn FROM (
  SELECT cast(o_custkey AS varchar) AS user_id, o_orderpriority AS segment, o_totalprice AS lifetime_value, o_orderkey AS lsn,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""",
)
def latest_per_key_(spark, sf_dir):
    latest = latest_per_key(segment_rows(spark, sf_dir), ["user_id"], ops.CHANGE_ORDER)
    return latest.select("user_id", "segment", "lifetime_value", "lsn")


@query(
    "merge_upsert",
    """
WITH updates AS (
  SELECT o_orderkey, o_custkey, cast(floor(o_totalprice * 110) AS double) / 100 AS price, o_orderdate + INTERVAL 1 DAY AS changed_at
  FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 1000 = 7),
merged AS (
  SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderdate AS changed_at FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
  UNION ALL SELECT * FROM updates)
SELECT o_orderkey, o_custkey, price, strftime(changed_at, '%Y-%m-%d %H:%M:%S.%f') AS changed_at FROM merged
""",
)
def merge_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("changed_at"))
    raised = stored.filter("o_orderkey % 2 = 0").withColumns(
        {"price": F.floor(F.col("price") * 110).cast("double") / 100, "changed_at": F.timestamp_add("DAY", F.lit(1), F.col("changed_at"))}
    )
    added = stored.filter("o_orderkey % 1000 = 7").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    merged = ops.upsert(stored, raised.unionByName(added), ["o_orderkey"], ["changed_at"])
    return merged.withColumn("changed_at", stamp(F.col("changed_at")))


@query(
    "stream_upsert",
    f"""
WITH {sql.SEGMENTS}
SELECT * EXCLUDE rn FROM (SELECT user_id, segment, lifetime_value, lsn,
  row_number() OVER (PARTITION BY user_id ORDER BY change_ts DESC, lsn DESC) AS rn FROM segments) WHERE rn = 1
""",
)
def stream_upsert(spark, sf_dir):
    root = workspace.fresh_folder(spark, "stream-upsert")
    orders = topics.stream_files(spark, sf_dir, schema=table(spark, sf_dir, "orders").schema, file_glob="orders.parquet")
    changes = ops.decode_changes(stand_ins.segment_changes(orders), CDC_TABLES["customer_segments"])
    keys = (["user_id"], ops.CHANGE_ORDER)
    start_upsert(changes, f"{root}/current", f"{root}/checkpoint", *keys).awaitTermination()
    current = current_rows(spark, f"{root}/current", changes.schema, *keys)
    return current.select("user_id", "segment", "lifetime_value", "lsn")


# ---- as-of joins ---------------------------------------------------------------------


def _shipped_lines(spark, sf_dir) -> DataFrame:
    """Line items with the customer of their order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("user_id")
    )
    return lines.join(owners, "l_orderkey")


_ASOF_SQL = f"""
WITH {sql.SEGMENT_HISTORY}, lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, cast(o_custkey AS varchar) AS user_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, h.segment AS segment, {sql.stamp('h.valid_from')} AS valid_from
FROM lines LEFT JOIN h ON lines.user_id = h.user_id AND l_shipdate >= h.valid_from
  AND l_shipdate < coalesce(h.valid_to, TIMESTAMP '2999-12-31')
"""


def _asof(spark, sf_dir, strategy: str) -> DataFrame:
    joined = asof_join(
        _shipped_lines(spark, sf_dir),
        segment_history(spark, sf_dir),
        {"user_id": "user_id"},
        "l_shipdate",
        {"segment": "segment", "valid_from": "version_from"},
        strategy=strategy,
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "segment", stamp(F.col("version_from")).alias("valid_from")
    )


@query("asof_scd2_join", _ASOF_SQL)
def asof_scd2_join(spark, sf_dir):
    return _asof(spark, sf_dir, "auto")


@query("asof_window_variant", _ASOF_SQL)
def asof_window_variant(spark, sf_dir):
    return _asof(spark, sf_dir, "timeline")


@query(
    "orphan_fact_rows",
    """
WITH first_order AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY 1)
SELECT o_orderpriority AS priority, count(*) AS lines, count(*) FILTER (l_shipdate < first_date) AS orphans
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN first_order USING (o_custkey) GROUP BY 1
""",
)
def orphan_fact_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("priority")
    )
    lines = _shipped_lines(spark, sf_dir).select("l_orderkey", "l_shipdate", "user_id")
    joined = asof_join(
        lines, segment_history(spark, sf_dir), {"user_id": "user_id"}, "l_shipdate", {"valid_from": "version_from"}
    )
    return joined.join(orders, "l_orderkey").groupBy("priority").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("version_from").isNull()).alias("orphans")
    )


@query(
    "unmatched_fact_rows",
    """
SELECT event_type, count(*) AS events FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1
""",
)
def unmatched_fact_rows(spark, sf_dir):
    # users of events that are no customers
    known = table(spark, sf_dir, "customer")
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    return unmatched_rows(events, known, {"user_id": "c_custkey"}).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


# ---- merged feeds --------------------------------------------------------------------


def customer_feeds(spark, sf_dir) -> DataFrame:
    users = ops.decode_changes(
        stand_ins.user_changes(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")), CDC_TABLES["users"]
    )
    return combine_feeds({"users": users, "customer_segments": segment_rows(spark, sf_dir)})


@query(
    "union_missing_columns",
    f"""
WITH {sql.SEGMENTS}
SELECT user_id, NULL AS email, NULL AS country, segment, lifetime_value, {sql.stamp('change_ts')} AS change_ts,
       'customer_segments' AS feed FROM segments
UNION ALL
SELECT cast(c_custkey AS varchar), c_name, n_name, NULL, NULL, '1995-01-01 00:00:00.000000', 'users'
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
)
def union_missing_columns(spark, sf_dir):
    return customer_feeds(spark, sf_dir).select(
        "user_id", "email", "country", "segment", "lifetime_value", stamp(F.col("change_ts")).alias("change_ts"), "feed"
    )


_OWNED = {"email": "users", "country": "users", "segment": "customer_segments", "lifetime_value": "customer_segments"}


@query(
    "consolidate_changes",
    f"""
WITH {sql.SEGMENTS}, feeds AS (
  SELECT user_id, change_ts, NULL AS email, NULL AS country, segment, lifetime_value, lsn, bronze_partition, bronze_offset,
    'customer_segments' AS feed FROM segments
  UNION ALL
  SELECT cast(c_custkey AS varchar), TIMESTAMP '1995-01-01', c_name, n_name, NULL, NULL, c_custkey, 0, c_custkey, 'users'
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT user_id, {sql.stamp('change_ts')} AS change_ts, max(email) AS email, max(country) AS country,
       arg_max(segment, lsn) FILTER (feed = 'customer_segments') AS segment,
       arg_max(lifetime_value, lsn) FILTER (feed = 'customer_segments') AS lifetime_value,
       max(bronze_partition) AS bronze_partition, max(bronze_offset) AS bronze_offset,
       string_agg(DISTINCT feed, ',' ORDER BY feed) AS change_source
FROM feeds GROUP BY user_id, feeds.change_ts
""",
)
def consolidate_changes(spark, sf_dir):
    merged = consolidate(customer_feeds(spark, sf_dir), ["user_id"], _OWNED)
    return merged.withColumn("change_ts", stamp(F.col("change_ts")))


@query(
    "forward_fill",
    f"""
WITH {sql.CUSTOMER_FEED}
SELECT user_id, {sql.stamp('change_ts')} AS change_ts, bronze_offset, feed, email, country, segment, lifetime_value, change_source
FROM filled
""",
)
def forward_fill_(spark, sf_dir):
    filled = forward_fill(
        customer_feeds(spark, sf_dir),
        ["user_id"],
        {"users": ["email", "country"], "customer_segments": ["segment", "lifetime_value"]},
        deleted_by="users",
    )
    return filled.select(
        "user_id", stamp(F.col("change_ts")).alias("change_ts"), "bronze_offset", "feed", "email", "country",
        "segment", "lifetime_value", "change_source",
    )


# ---- keys ----------------------------------------------------------------------------


@query(
    "state_fingerprint",
    """
SELECT o_orderkey, sha256(concat_ws('|', 'v' || replace(replace(o_orderstatus, '\\', '\\\\'), '|', '\\|'),
    'v' || replace(replace(o_orderpriority, '\\', '\\\\'), '|', '\\|'),
    CASE WHEN o_custkey % 5 = 0 THEN 'n' ELSE 'v' || cast(o_custkey AS varchar) END)) AS fingerprint
FROM orders
""",
)
def state_fingerprint_(spark, sf_dir):
    customer = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        state_fingerprint(F.col("o_orderstatus"), F.col("o_orderpriority"), customer).alias("fingerprint"),
    )


@query(
    "surrogate_key_uniqueness",
    """
SELECT count(*) AS tuples, count(*) AS keys FROM (
  SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS p,
                  CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey END AS s FROM lineitem)
""",
)
def surrogate_key_uniqueness(spark, sf_dir):
    tuples = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey")).alias("p"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("s"),
    ).distinct()
    keyed = tuples.withColumn("sk", surrogate_key(*[F.col(c) for c in tuples.columns]))
    per_key = keyed.groupBy("sk").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("tuples"), F.count(F.lit(1)).alias("keys"))
