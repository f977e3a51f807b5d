"""State as of a time from kept states and the changes since.

Changes lie in one folder per month of their time. At chosen times the latest row of every key is
kept (deletes included, so that order decides as it does over all changes). A read takes the nearest
kept state before its time and replays only the changes between, from the folders between.

A change that arrives late would make later kept states wrong, so appending it drops those; they can
be kept again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.changes import CHANGE_ORDER
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.settle import settle
from tidemark.workspace import path_exists

MONTH = "_month"
STAMP = "%Y%m%dT%H%M%S.%f"


def _system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def kept_times(spark: SparkSession, path: str) -> list[datetime]:
    """Times of the finished kept states, ascending; few, as somebody chose them."""
    if not path_exists(spark, f"{path}/states"):
        return []
    system, folder = _system(spark, f"{path}/states")
    names = [s.getPath().getName() for s in system.listStatus(folder) if path_exists(spark, f"{s.getPath()}/_SUCCESS")]
    return sorted(datetime.strptime(n[3:], STAMP) for n in names if re.match("at=", n))


def append_changes(changes: DataFrame, path: str, at: str = CHANGE_ORDER[0]) -> None:
    """Add changes; kept states from the time of the earliest of them on are dropped first."""
    spark = changes.sparkSession
    changes = settle(changes, "changes", above=0)
    first = changes.agg(F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if first is not None:
        for time in kept_times(spark, path):
            if time >= datetime.fromisoformat(first):
                system, folder = _system(spark, f"{path}/states/at={time.strftime(STAMP)}")
                system.delete(folder, True)
    dated = changes.withColumn(MONTH, F.trunc(F.col(at).cast("date"), "MM"))
    dated.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(f"{path}/changes")


def _latest(
    spark: SparkSession, path: str, columns: T.StructType, keys: Sequence[str], at: datetime, order: Sequence[str]
) -> DataFrame:
    """Latest row per key up to a time, deletes included."""
    layout = T.StructType([*columns.fields, T.StructField(MONTH, T.DateType())])
    changes = spark.read.schema(layout).parquet(f"{path}/changes")
    last = F.lit(at)
    seen = changes.filter((F.col(order[0]) <= last) & (F.col(MONTH) <= F.lit(at.date())))
    earlier = [t for t in kept_times(spark, path) if t <= at]
    if earlier:
        kept = earlier[-1]
        seen = seen.filter((F.col(order[0]) > F.lit(kept)) & (F.col(MONTH) >= F.lit(kept.date().replace(day=1))))
        stored = spark.read.schema(columns).parquet(f"{path}/states/at={kept.strftime(STAMP)}")
        return latest_per_key(seen.drop(MONTH).unionByName(stored), keys, order)
    return latest_per_key(seen.drop(MONTH), keys, order)


def keep_state(
    spark: SparkSession, path: str, columns: T.StructType, keys: Sequence[str], at: datetime, order: Sequence[str] = CHANGE_ORDER
) -> None:
    """Keep the state at a time, from the nearest one before it. Times are in the session's zone."""
    _latest(spark, path, columns, keys, at, order).write.mode("overwrite").parquet(f"{path}/states/at={at.strftime(STAMP)}")


def state_at(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    keys: Sequence[str],
    at: datetime,
    order: Sequence[str] = CHANGE_ORDER,
    deleted: str = "is_delete",
) -> DataFrame:
    """:func:`~tidemark.operators.changes.state_as_of`, reading only changes after a kept state."""
    return _latest(spark, path, columns, keys, at, order).filter(~F.col(deleted))
