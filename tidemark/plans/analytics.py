"""Analytics over customers and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.casts import exact_sum


def _average(column: str) -> Column:
    return exact_sum(F.col(column)).cast("double") / F.count(column)


def segment_profile(customers: DataFrame, segment: str, value: str) -> DataFrame:
    return (
        customers.groupBy(segment)
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            _average(value).alias("avg_lifetime_value"),
            F.max(value).alias("max_lifetime_value"),
        )
        .orderBy(F.desc("avg_lifetime_value"), segment)
    )


def monthly_trend(orders: DataFrame, at: str, amount: str) -> DataFrame:
    return (
        orders.groupBy(F.year(at).alias("year"), F.month(at).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            exact_sum(F.col(amount)).cast("double").alias("total_revenue"),
            _average(amount).alias("avg_order_value"),
        )
        .orderBy("year", "month")
    )


def top_customers(customers: DataFrame, orders: DataFrame, customer: str, amount: str, n: int = 10) -> DataFrame:
    """Customers by money spent. Customers without orders are out, so orders are summed per
    customer first and the join carries one row per buyer."""
    spent = orders.groupBy(customer).agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(F.col(amount)).cast("double").alias("total_spent"),
        _average(amount).alias("avg_order_value"),
    )
    return customers.join(spent, customer).orderBy(F.desc("total_spent"), customer).limit(n)


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column, one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*")
