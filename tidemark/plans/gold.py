"""Metrics over facts and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.casts import exact_sum, safe_ratio


def revenue_cadence(sales: DataFrame, at: str, amount: str, by: Sequence[str], grain: str = "week") -> DataFrame:
    """Revenue and orders per day, week (from Monday) or month and attribute."""
    return sales.groupBy(F.date_trunc(grain, at).cast("date").alias("period_start"), *by).agg(
        F.count(F.lit(1)).alias("orders"),
        exact_sum(F.col(amount)).cast("double").alias("revenue"),
    )


def cohort_conversion(
    interactions: DataFrame, user: str, at: str, engaged: Column, converted: Column, grain: str = "week"
) -> DataFrame:
    """Users by the period of their first event: how many engaged, how many of those converted."""
    users = interactions.groupBy(user).agg(
        F.date_trunc(grain, F.min(at)).cast("date").alias("cohort"),
        F.max(engaged.cast("int")).alias("_engaged"),
        F.max(converted.cast("int")).alias("_converted"),
    )
    cohorts = users.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("_engaged") == 1).alias("engaged_users"),
        F.count_if((F.col("_engaged") == 1) & (F.col("_converted") == 1)).alias("converted_users"),
    )
    return cohorts.withColumn("conversion_rate", safe_ratio(F.col("converted_users"), F.col("engaged_users")))


def inventory_health(positions: DataFrame, warehouse: str, quantity: str, delta: str, low_level: int) -> DataFrame:
    """Average level and net change per warehouse, flagging warehouses that run low."""
    health = positions.groupBy(warehouse).agg(
        F.count(F.lit(1)).alias("changes"),
        safe_ratio(F.sum(F.col(quantity).cast("bigint")), F.count(quantity)).alias("avg_level"),
        F.sum(F.col(delta).cast("bigint")).alias("net_change"),
        F.min(F.col(quantity).cast("bigint")).alias("lowest_level"),
    )
    return health.withColumn("runs_low", F.col("lowest_level") < low_level)


def supplier_scorecard(shipments: DataFrame, suppliers: DataFrame, supplier: str, on_time: Column) -> DataFrame:
    """Rating beside the share of shipments on time; suppliers without shipments stay.

    ``suppliers`` is unique by ``supplier``. Shipments are counted before the join, so only
    one row per supplier travels.
    """
    delivered = shipments.groupBy(supplier).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(on_time).alias("on_time"),
    )
    joined = suppliers.join(delivered, supplier, "left").fillna(0, ["shipments", "on_time"])
    return joined.withColumn("on_time_share", safe_ratio(F.col("on_time"), F.col("shipments")))


def customer_value(orders: DataFrame, customers: DataFrame, customer: str, amount: str, recorded: str) -> DataFrame:
    """Sum of orders beside the value recorded for the customer; ``customers`` is unique."""
    spent = orders.groupBy(customer).agg(
        F.count(F.lit(1)).alias("orders"), exact_sum(F.col(amount)).cast("double").alias("ordered_value")
    )
    joined = customers.join(spent, customer, "left").fillna(0, ["orders"]).fillna(0.0, ["ordered_value"])
    return joined.withColumn("value_ratio", safe_ratio(F.col("ordered_value"), F.col(recorded)))


def funnel_rates(order_facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Orders, orders with a payment, and paid orders with a shipment."""
    paid = F.col("payment_id").isNotNull()
    counted = order_facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(paid).alias("paid_orders"),
        F.count_if(paid & F.col("shipment_id").isNotNull()).alias("shipped_orders"),
        F.count_if(F.col("payment_status") == "SETTLED").alias("settled_orders"),
    )
    return counted.withColumns(
        {
            "payment_rate": safe_ratio(F.col("paid_orders"), F.col("orders")),
            "shipment_rate": safe_ratio(F.col("shipped_orders"), F.col("paid_orders")),
        }
    )
