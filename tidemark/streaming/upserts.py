"""Keyed upserts from a stream into a stored table.

Every batch appends its newest row per key to a folder of its own; readers take the newest row per
key over all folders. A batch therefore costs what it brings, never the table. ``compact_upserts``
merges the folders up to a batch into one base when there are many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ranking import latest_per_key
from tidemark.workspace import path_exists

BATCH = "batch"
BASE = "upto"


def _layer(spark: SparkSession, path: str, columns: T.StructType, number: str) -> DataFrame:
    layout = T.StructType([*columns.fields, T.StructField(number, T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def _finished_base(spark: SparkSession, path: str) -> int | None:
    """Last batch that a finished compaction covers. Compactions are few folders."""
    if not path_exists(spark, f"{path}/base"):
        return None
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/base")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    folders = [status.getPath() for status in found if status.getPath().getName().startswith(f"{BASE}=")]
    done = [f for f in folders if path_exists(spark, f"{f}/_SUCCESS")]
    return max((int(f.getName().split("=")[1]) for f in done), default=None)


def current_rows(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    before: int | None = None,
) -> DataFrame:
    """Newest row per key after the last batch, or after the last one before a number.

    On equal ``order`` the later batch wins. With ``before`` the base is used only if it covers
    no later batch.
    """
    base = _finished_base(spark, path)
    if base is not None and before is not None and base >= before:
        base = None
    changes = _layer(spark, f"{path}/changes", columns, BATCH)
    changes = changes.filter(F.col(BATCH) < before) if before is not None else changes
    if base is not None:
        stored = _layer(spark, f"{path}/base", columns, BASE).filter(F.col(BASE) == base)
        changes = changes.filter(F.col(BATCH) > base).unionByName(stored.withColumnRenamed(BASE, BATCH))
    return latest_per_key(changes, keys, [*order, BATCH])


def upsert_batch(updates: DataFrame, batch: int, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append the newest update per key. A repeated batch replaces its own folder only."""
    latest_per_key(updates, keys, order).write.mode("overwrite").parquet(f"{path}/changes/{BATCH}={batch}")


def compact_upserts(
    spark: SparkSession, path: str, columns: T.StructType, keys: Sequence[str], order: Sequence[str], upto: int
) -> None:
    """Merge all batches up to a number into one base. Readers use it once it is finished."""
    merged = current_rows(spark, path, columns, keys, order, before=upto + 1).drop(BATCH)
    merged.write.mode("overwrite").parquet(f"{path}/base/{BASE}={upto}")


def start_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    compact_every: int = 50,
) -> StreamingQuery:
    """Keep a table of the newest row per key up to date with all waiting changes, then stop."""
    columns = stream.schema

    def keep(rows: DataFrame, number: int) -> None:
        upsert_batch(rows, number, path, keys, order)
        if number and number % compact_every == 0:
            compact_upserts(rows.sparkSession, path, columns, keys, order, number)

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
