"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is written to the shared folder, so lost executors never replay earlier rounds.
A node with very many links is only ever the key of an aggregate or of a join whose other side is
a written table with one row for it; adaptive execution can split such a join's large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import stage


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], int(row["h"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("high", "low").union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = stage(both.groupBy("high").agg(F.least(F.col("high"), F.min("low")).alias("least")), "least")
    return (
        both.filter("low > high")
        .join(least, "high")
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .filter("high > low")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = stage(links.groupBy("high").agg(F.min("low").alias("least")), "least")
    joined = links.join(least, "high")
    return (
        joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .union(least.select("high", F.col("least").alias("low")))
        .filter("high > low")
        .distinct()
    )


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root`` for every node with a link to a smaller one; roots are the smallest nodes."""
    links = stage(
        links.select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
        .filter("high > low")
        .distinct(),
        "links",
    )
    before = _state(links)
    while before[0]:
        links = stage(_small_star(_large_star(links)), "stars")
        now = _state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
