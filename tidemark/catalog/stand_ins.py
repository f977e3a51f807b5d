"""Bronze feeds derived from the shared test tables.

Every feed is computed by Spark from whole tables: orders carry customer segments and order
events, line items carry prices, stock and shipments, events carry interactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import wire
from tidemark.sources.tables import spread_rows

SCHEMA_ID = 17
FIRST_DAY = "1995-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its timestamps as TIMESTAMP."""
    return zoned(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def zoned(df: DataFrame) -> DataFrame:
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def first_day() -> Column:
    return F.lit(FIRST_DAY).cast("timestamp")


def iso(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


# ---- topic records -------------------------------------------------------------------


def topic_records(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Events as broker records: topic by type, three partitions, offsets by id."""
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        (framed_props() if value is None else value).alias("value"),
    )


def framed_props() -> Column:
    return wire.frame(F.lit(SCHEMA_ID), F.encode("props", "UTF-8"))


def faulty_props() -> Column:
    """Framed payloads where every 77th is cut to 3 bytes and every 50th has a wrong first byte."""
    good = framed_props()
    wrong_magic = F.concat(F.lit(b"\x01"), good.substr(F.lit(2), F.octet_length(good)))
    return (
        F.when(F.col("event_id") % 77 == 0, F.substring(good, 1, 3))
        .when(F.col("event_id") % 50 == 0, wrong_magic)
        .otherwise(good)
    )


def bronze_rows(source: str | Column, at: Column, payload: Column, partition: Column, offset: Column) -> list[Column]:
    text = F.to_json(payload, {"ignoreNullFields": "false"})
    return [
        (F.lit(source) if isinstance(source, str) else source).alias("event_source"),
        at.alias("event_time"),
        F.lit(SCHEMA_ID).alias("schema_id"),
        F.octet_length(text).alias("payload_size"),
        text.alias("json_payload"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
    ]


# ---- change feeds --------------------------------------------------------------------


def envelope(image: Column, op: Column, at: Column, lsn: Column, table_name: str) -> Column:
    """Change envelope: deletes carry the image before, everything else the image after."""
    return F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.struct(lsn.alias("lsn"), F.unix_millis(at).alias("ts_ms"), F.lit(table_name).alias("table")).alias("source"),
        op.alias("op"),
        F.unix_millis(at).alias("ts_ms"),
    )


def _changes(df: DataFrame, table_name: str, image: Column, op: Column, at: Column, lsn: Column, partition: Column, offset: Column) -> DataFrame:
    payload = envelope(image, op, at, lsn, table_name)
    return df.select(*bronze_rows(f"demo.public.{table_name}", at, payload, partition, offset))


def segment_image() -> Column:
    return F.struct(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_totalprice").alias("lifetime_value"),
    )


def segment_changes(orders: DataFrame) -> DataFrame:
    """Customer segments: one change per order, a delete at every 41st order key."""
    op = F.when(F.col("o_orderkey") % 41 == 0, "d").otherwise("u")
    return _changes(
        spread_rows(orders, "o_orderkey"), "customer_segments", segment_image(), op, F.col("o_orderdate"), F.col("o_orderkey"),
        F.col("o_custkey") % 4, F.col("o_orderkey"),
    )


def user_changes(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Users: one snapshot row per customer on the first day."""
    users = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    image = F.struct(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("email"),
        F.col("n_name").alias("country"),
        iso(first_day()).alias("created_at"),
    )
    return _changes(users, "users", image, F.lit("r"), first_day(), F.col("c_custkey"), F.lit(0), F.col("c_custkey"))


def product_changes(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Products: list price on the first day, then the unit price of every line shipped."""
    listed = part.select(
        F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("price"), first_day().alias("at"),
        F.lit(-1).cast("bigint").alias("lsn"), F.lit(0).alias("partition"), F.col("p_partkey").alias("offset"),
    )
    sold = spread_rows(lineitem, "l_orderkey").select(
        F.col("l_partkey").alias("key"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"),
        F.col("l_shipdate").alias("at"), F.col("l_orderkey").alias("lsn"),
        F.col("l_suppkey").cast("int").alias("partition"), line_offset().alias("offset"),
    )
    rows = listed.unionByName(sold)
    image = F.struct(
        F.col("key").cast("string").alias("product_id"),
        F.concat(F.lit("Part#"), F.col("key").cast("string")).alias("title"),
        F.concat(F.lit("Group#"), (F.col("key") % 25).cast("string")).alias("category"),
        F.col("price").alias("price_usd"),
    )
    return _changes(rows, "products", image, F.lit("u"), F.col("at"), F.col("lsn"), F.col("partition"), F.col("offset"))


def line_offset() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def supplier_changes(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Suppliers: first day as is; 1998 the same again, but no rating for every 7th; every
    11th is deleted in 2000."""
    known = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    steps = F.array(
        F.struct(F.lit("r").alias("op"), F.lit("1995-01-01").cast("timestamp").alias("at"), F.lit(0).alias("step")),
        F.struct(F.lit("u").alias("op"), F.lit("1998-01-01").cast("timestamp").alias("at"), F.lit(1).alias("step")),
        F.struct(F.lit("d").alias("op"), F.lit("2000-01-01").cast("timestamp").alias("at"), F.lit(2).alias("step")),
    )
    rows = known.withColumn("s", F.explode(steps)).filter((F.col("s.step") < 2) | (F.col("s_suppkey") % 11 == 0))
    rating = F.when((F.col("s.step") == 0) | (F.col("s_suppkey") % 7 != 0), F.col("s_acctbal"))
    image = F.struct(
        F.col("s_suppkey").cast("string").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("country"),
        rating.alias("rating"),
    )
    return _changes(
        rows, "suppliers", image, F.col("s.op"), F.col("s.at"), F.col("s_suppkey") * 3 + F.col("s.step"),
        F.lit(0), F.col("s_suppkey") * 3 + F.col("s.step"),
    )


def warehouse_changes(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Warehouses: every supplier with its nation and region on the first day."""
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    rows = supplier.join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    image = F.struct(
        F.col("s_suppkey").cast("string").alias("warehouse_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
    )
    return _changes(rows, "warehouses", image, F.lit("r"), first_day(), F.col("s_suppkey"), F.lit(0), F.col("s_suppkey"))


def stock_changes(lineitem: DataFrame) -> DataFrame:
    """Warehouse stock: each line item sets the quantity of its part at its supplier."""
    image = F.struct(
        F.col("l_suppkey").cast("string").alias("warehouse_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_linenumber").cast("bigint").alias("reserved_qty"),
    )
    return _changes(
        spread_rows(lineitem, "l_orderkey"), "warehouse_inventory", image, F.lit("u"), F.col("l_shipdate"), F.col("l_orderkey"),
        F.col("l_partkey"), line_offset(),
    )


# ---- event topics --------------------------------------------------------------------


def order_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders, payments and shipments in one bronze table.

    Settled orders (status F) have a pending payment before; status P failed, and every
    third of those has no payment at all. Every line item is a shipment.
    """
    orders, lineitem = spread_rows(orders, "o_orderkey"), spread_rows(lineitem, "l_orderkey")
    placed = orders.select(
        *bronze_rows(
            "orders.v1",
            F.col("o_orderdate"),
            F.struct(
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                (F.col("o_orderkey") % 200).cast("string").alias("product_id"),
                F.col("o_totalprice").alias("amount"),
                iso(F.col("o_orderdate")).alias("ts"),
            ),
            F.col("o_custkey") % 4,
            F.col("o_orderkey"),
        )
    )
    # an array per order: (status, hours after the order)
    tries = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.array(*[F.struct(F.lit(s).alias("status"), F.lit(h).alias("hours")) for s, h in (("PENDING", 1), ("SETTLED", 2))]),
        )
        .when(F.col("o_orderstatus") == "O", F.array(F.struct(F.lit("PENDING").alias("status"), F.lit(1).alias("hours"))))
        .when(F.col("o_orderkey") % 3 != 0, F.array(F.struct(F.lit("FAILED").alias("status"), F.lit(1).alias("hours"))))
    )
    attempts = orders.withColumn("t", F.explode(tries)).withColumn(
        "at", F.timestamp_add("HOUR", F.col("t.hours"), F.col("o_orderdate"))
    )
    paid = attempts.select(
        *bronze_rows(
            "payments.v1",
            F.col("at"),
            F.struct(
                F.concat(F.lit("PAY-"), F.col("o_orderkey").cast("string")).alias("payment_id"),
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.lit("CARD").alias("method"),
                F.col("t.status").alias("status"),
                iso(F.col("at")).alias("ts"),
            ),
            F.col("o_custkey") % 4,
            F.col("o_orderkey") * 2 + F.col("t.hours"),
        )
    )
    shipped = lineitem.select(
        *bronze_rows(
            "shipments.v1",
            F.col("l_shipdate"),
            F.struct(
                F.concat_ws("-", F.lit("SHP"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("shipment_id"),
                F.col("l_orderkey").cast("string").alias("order_id"),
                F.col("l_returnflag").alias("carrier"),
                F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("eta_days"),
                iso(F.col("l_shipdate")).alias("ts"),
            ),
            F.col("l_partkey"),
            line_offset(),
        )
    )
    return placed.unionByName(paid).unionByName(shipped)


def inventory_events(lineitem: DataFrame) -> DataFrame:
    """Stock movements: returns add, everything else takes; every 89th order breaks the rule."""
    back = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    delta = F.when(back, quantity).otherwise(-quantity)
    before = F.col("l_linenumber") * 10
    after = F.greatest(F.lit(0), before + delta) + F.when(F.col("l_orderkey") % 89 == 0, 1).otherwise(0)
    return spread_rows(lineitem, "l_orderkey").select(
        *bronze_rows(
            "inventory-changes.v1",
            F.col("l_shipdate"),
            F.struct(
                F.concat_ws("-", F.lit("CHG"), line_offset().cast("string")).alias("change_id"),
                F.col("l_suppkey").cast("string").alias("warehouse_id"),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.when(back, "RETURN").otherwise("SALE").alias("change_type"),
                delta.alias("quantity_delta"),
                before.alias("previous_qty"),
                after.alias("new_qty"),
                F.col("l_linestatus").alias("reason"),
                F.col("l_orderkey").cast("string").alias("order_id"),
                iso(F.col("l_shipdate")).alias("ts"),
            ),
            F.col("l_partkey"),
            line_offset(),
        )
    )


def interaction_events(events: DataFrame) -> DataFrame:
    """Interactions: purchase, error, signup and view touch product ``k``; a click is a search
    and has no product."""
    kind = (
        F.when(F.col("event_type") == "purchase", "CART_ADD")
        .when(F.col("event_type") == "error", "CART_REMOVE")
        .when(F.col("event_type") == "signup", "REVIEW")
        .when(F.col("event_type") == "click", "SEARCH")
        .otherwise("PAGE_VIEW")
    )
    return spread_rows(events, "event_id").select(
        *bronze_rows(
            "customer-interactions.v1",
            F.col("ts"),
            F.struct(
                F.col("event_id").cast("string").alias("interaction_id"),
                F.col("user_id").cast("string").alias("user_id"),
                F.concat_ws("-", F.lit("S"), F.col("user_id").cast("string")).alias("session_id"),
                kind.alias("interaction_type"),
                F.when(F.col("event_type") != "click", F.get_json_object("props", "$.k")).alias("product_id"),
                F.floor(F.col("value") * 100).alias("duration_ms"),
                iso(F.col("ts")).alias("ts"),
            ),
            F.col("event_id") % 3,
            F.expr("event_id div 3"),
        )
    )


def calendar_bounds(orders: DataFrame, lineitem: DataFrame, events: DataFrame) -> DataFrame:
    """First day of the first year and last day of the last year that any table mentions."""
    days = (
        orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        .unionByName(lineitem.agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")))
        .unionByName(events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")))
    )
    return days.agg(
        F.trunc(F.min("a"), "year").alias("first"),
        F.date_add(F.add_months(F.trunc(F.max("b"), "year"), 12), -1).alias("last"),
    )


def star_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All bronze feeds of the star schema."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    t = {name: table(spark, sf_dir, name) for name in names}
    return {
        "users": user_changes(t["customer"], t["nation"]),
        "customer_segments": segment_changes(t["orders"]),
        "products": product_changes(t["part"], t["lineitem"]),
        "suppliers": supplier_changes(t["supplier"], t["nation"]),
        "warehouses": warehouse_changes(t["supplier"], t["nation"], t["region"]),
        "warehouse_inventory": stock_changes(t["lineitem"]),
        "raw_events": order_events(t["orders"], t["lineitem"])
        .unionByName(inventory_events(t["lineitem"]))
        .unionByName(interaction_events(t["events"])),
        "calendar_bounds": calendar_bounds(t["orders"], t["lineitem"], t["events"]),
    }
