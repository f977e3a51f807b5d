"""Upkeep of stored tables: changes, compaction, retention, file statistics, repeatable appends."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.operators.changes import delete_where, update_where, upsert
from tidemark.operators.ranking import first_n_per_key, latest_per_key
from tidemark.operators.sizing import broadcast_if_small
from tidemark.sources.files import (
    BIN, file_column, finish_swaps, list_files, read_files, replace_files, stored_schema, touched_files,
)
from tidemark.workspace import fresh_folder

TARGET_FILE_BYTES = 128 * 1024 * 1024


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per partition folder, from file listings only."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    return files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.min("length").alias("smallest"),
        F.max("length").alias("largest"),
    )


def compact(
    spark: SparkSession,
    path: str,
    staged_path: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite a Parquet table into files of about ``target_bytes`` at a staged path.

    A rebalance lets adaptive execution merge small partitions and split large ones at run
    time, so a source with a third of the rows becomes many files, not one. Returns the
    staged table; the caller swaps it in after checking it.
    """
    # a session of its own: settings of the caller's session stay as they are
    own = spark.newSession()
    for name, value in {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        own.conf.set(name, value)
    writer = own.read.parquet(path).hint("rebalance", *partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged_path)
    return spark.read.parquet(staged_path)


def rewrite_touched(
    table: DataFrame, path: str, partition_by: Sequence[str], touched: Column, change: Callable[[DataFrame], DataFrame]
) -> int:
    """Apply a change to a stored table, rewriting only the files with a touched row.

    Rows may move to other partitions: they are added there as new files. Returns the number of
    files rewritten.
    """
    spark = table.sparkSession
    finish_swaps(spark, path)
    schema = stored_schema(table.schema, partition_by)
    stored = spark.read.schema(schema).parquet(path)
    old = touched_files(stored.filter(F.coalesce(touched, F.lit(False))))
    if old:
        replace_files(spark, path, old, change(read_files(spark, path, schema, old)), partition_by)
    return len(old)


def update_stored(
    table: DataFrame, path: str, partition_by: Sequence[str], condition: Column, assignments: Mapping[str, Column]
) -> int:
    """SQL UPDATE of a stored table. Any column may change, those of the partitions included."""
    kinds = {n: v.cast(table.schema[n].dataType) for n, v in assignments.items()}
    return rewrite_touched(table, path, partition_by, condition, lambda df: update_where(df, condition, kinds))


def delete_stored(table: DataFrame, path: str, partition_by: Sequence[str], condition: Column) -> int:
    """SQL DELETE from a stored table."""
    return rewrite_touched(table, path, partition_by, condition, lambda df: delete_where(df, condition))


def merge_stored(
    table: DataFrame, path: str, partition_by: Sequence[str], updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> int:
    """SQL MERGE by key into a stored table; the newest row by ``order`` wins, new keys are added.

    Which files hold a key of the updates is found from the key columns alone, and only in row
    groups whose key ranges meet those of the updates. Returns the number of files rewritten.
    """
    spark = table.sparkSession
    finish_swaps(spark, path)
    schema = stored_schema(table.schema, partition_by)
    updates = stage_rows(latest_per_key(updates, keys, order).select(*schema.names), "updates")
    ends = updates.agg(
        *[F.min(k).alias(f"low_{i}") for i, k in enumerate(keys)], *[F.max(k).alias(f"high_{i}") for i, k in enumerate(keys)]
    ).first()
    stored = spark.read.schema(schema).parquet(path)
    for i, key in enumerate(keys):
        if ends[f"low_{i}"] is None:  # no update, or none with this key
            continue
        within = F.col(key).between(F.lit(ends[f"low_{i}"]), F.lit(ends[f"high_{i}"]))
        stored = stored.filter(F.col(key).isNull() | within)
    named = updates.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    old = touched_files(stored.join(broadcast_if_small(named), same, "left_semi"))
    replace_files(spark, path, old, upsert(read_files(spark, path, schema, old), updates, keys, order), partition_by)
    return len(old)


def compact_binpack(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Merge undersized files of a stored table in place; returns how many there were.

    The plan comes from file sizes: files below 90 % of the target are laid end to end per
    partition and cut at multiples of the target. Large files, files that would be alone and files
    that are added meanwhile stay as they are.
    """
    finish_swaps(spark, path)
    small = list_files(spark, path).filter(F.col("bytes") < F.lit(0.9 * target_bytes))
    along = Window.partitionBy("folder").orderBy("bytes", "path")
    laid = small.withColumn("place", F.sum("bytes").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    binned = laid.withColumn("number", F.floor((F.col("place") - 1) / F.lit(target_bytes)))
    several = F.count(F.lit(1)).over(Window.partitionBy("folder", "number")) > 1
    plan = binned.withColumn("_several", several).filter("_several")
    plan = stage_rows(plan.select(F.col("path").alias("_file"), F.xxhash64("folder", "number").alias(BIN)), "file-plan")
    old = [r[0] for r in plan.select("_file").collect()]  # files, as many as the driver lists anyway
    if not old:
        return 0
    schema = stored_schema(schema, partition_by)
    rows = read_files(spark, path, schema, old)
    before = rows.count()

    def same_count(written: DataFrame) -> None:
        if written.count() != before:
            raise RuntimeError(f"compaction of {path} would change its rows")

    binned_rows = rows.withColumn("_file", file_column()).join(broadcast_if_small(plan), "_file").drop("_file")
    replace_files(spark, path, old, binned_rows, partition_by, same_count, binned=True)
    return len(old)


def retain_stored(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    cutoff: Column,
    keep_at_least: int = 1,
) -> tuple[int, int]:
    """:func:`retain_recent` of a stored table in place; returns files removed whole and rewritten.

    What goes is found from keys and order columns; files that lose no row are left alone, files
    that lose all are removed unread, and only those at the border are rewritten.
    """
    finish_swaps(spark, path)
    schema = stored_schema(schema, partition_by)
    stored = spark.read.schema(schema).parquet(path)
    at = F.col(order[0])
    narrow = stored.select(
        *dict.fromkeys([*keys, *order]), file_column().alias("_file"), F.col("_metadata.row_index").alias("_place")
    )
    newest = first_n_per_key(narrow.filter(at.isNotNull()), keys, [*order, "_file", "_place"], keep_at_least, newest=True)
    kept_old = stage_rows(newest.filter(at < cutoff).select("_file", "_place"), "kept-old")
    counts = narrow.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(at < cutoff).alias("old"))
    kept = kept_old.groupBy("_file").agg(F.count(F.lit(1)).alias("kept"))
    losing = counts.join(kept, "_file", "left").withColumn("goes", F.col("old") - F.coalesce("kept", F.lit(0)))
    found = losing.filter("goes > 0").select("_file", (F.col("goes") == F.col("rows")).alias("whole")).collect()
    whole, border = ([r["_file"] for r in found if r["whole"] == w] for w in (True, False))
    if not found:
        return 0, 0
    rows = read_files(spark, path, schema, border)
    if border:
        rows = rows.select("*", file_column().alias("_file"), F.col("_metadata.row_index").alias("_place"))
        stay = rows.filter(at.isNull() | (at >= cutoff)).drop("_file", "_place")
        rows = stay.unionByName(rows.filter(at < cutoff).join(kept_old, ["_file", "_place"], "left_semi").drop("_file", "_place"))
    replace_files(spark, path, [*whole, *border], rows, partition_by)
    return len(whole), len(border)


def stage_rows(df: DataFrame, label: str) -> DataFrame:
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def retain_recent(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cutoff: Column, keep_at_least: int = 1
) -> DataFrame:
    """Drop rows older than the cutoff, but keep the newest ``keep_at_least`` rows per key.

    Rows without a time cannot be called old and stay.
    """
    at = F.col(order[0])
    kept_old = first_n_per_key(df.filter(at.isNotNull()), keys, order, keep_at_least, newest=True).filter(at < cutoff)
    return df.filter(at.isNull() | (at >= cutoff)).unionByName(kept_old)


def only_new_records(
    incoming: DataFrame, stored: DataFrame, identity: Sequence[str] = ("event_source", "partition", "offset")
) -> DataFrame:
    """Records not stored yet, each once; appending them again and again adds nothing."""
    return incoming.dropDuplicates(list(identity)).join(
        stored.select(*identity), list(identity), "left_anti"
    )
