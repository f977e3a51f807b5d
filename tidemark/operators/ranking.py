"""Latest row and first rows per key.

``row_number() <= n`` lets Spark cut every map task to n rows per key before the shuffle
(WindowGroupLimit), so a hot key never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, *, newest: bool = False
) -> DataFrame:
    """The first (or newest) n rows of each key; ``order`` should be total."""
    direction = [F.col(c).desc() if newest else F.col(c).asc() for c in order]
    window = Window.partitionBy(*keys).orderBy(*direction)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_n_per_key(df, keys, order, 1, newest=True)


def newest_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The newest n rows of the whole table (per-task top n, then one merge)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
