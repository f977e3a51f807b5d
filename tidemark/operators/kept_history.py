"""Type-2 history that is stored and kept up to date batch by batch.

A rebuild of all versions reads all changes ever made. Here a batch of changes, in any order and
however late, is merged into a stored history:

* The history lies in hash buckets of the key, one folder each. Only the files of buckets that hold
  a key of the batch are read, and in those only the keys of the batch are worked on; the other
  rows are copied. New files take the place of the old ones in one swap.
* Stored is the last change of every key and instant, also where it repeats the state before it: a
  late change may part two equal states, which then are two versions. Such rows are marked, and
  :func:`read_history` leaves them out, as well as deletes.
* Of a touched key, the changes of the batch join those stored, and states, ends and marks follow
  from the order again. So a batch closes, splits and joins versions, and the result does not
  depend on how changes were dealt to batches or how often one is merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.history import open_end
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.settle import settle
from tidemark.operators.sizing import broadcast_if_small
from tidemark.operators.timeline import Timeline
from tidemark.sources.files import finish_swaps, read_files, replace_files, stored_schema, touched_files
from tidemark.workspace import path_exists

BUCKET = "_bucket"
OPENS = "_opens"
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def stored_layout(columns: T.StructType) -> T.StructType:
    """Columns of the stored history, from those of the changes."""
    more = [
        T.StructField(OPENS, T.BooleanType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("is_current", T.BooleanType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
    return T.StructType([*columns.fields, *more])


def _versions(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], state: Sequence[str], deleted: str | None, rows_per_task: int | None
) -> DataFrame:
    """Last change of every key and instant, with the version it opens or stands in."""
    at = order[0]
    last = latest_per_key(changes, [*keys, at], order)
    if rows_per_task is None:
        last = settle(last, "instants")
    timeline = Timeline.of(last, keys, order, rows_per_task)
    compared = [*state, deleted] if deleted else list(state)
    seen = timeline.extend(timeline.attach(last), previous={"_before": F.struct(*[F.col(c) for c in compared])})
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col("_before")[c]) for c in compared])
    marked = seen.withColumn(OPENS, F.col("_before").isNull() | differs).drop("_before")
    # a version ends where the next one opens: the earliest opening behind a row
    if timeline.cuts is not None:
        marked = settle(marked, "marked", above=0)
    opening = timeline.extend(marked.filter(OPENS), following={"_end": F.col(at)})
    repeats = marked.filter(~F.col(OPENS)).withColumn("_end", F.lit(None).cast("timestamp"))
    return timeline.detach(
        opening.unionByName(repeats).withColumns(
            {
                "valid_from": F.col(at),
                "valid_to": F.coalesce(F.col("_end"), open_end()),
                "is_current": F.col(OPENS) & F.col("_end").isNull(),
            }
        ).drop("_end")
    )


def merge_history(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    deleted: str | None = None,
    buckets: int = BUCKETS,
    rows_per_task: int | None = None,
) -> list[int]:
    """Merge a batch of changes into the history stored at a path; returns the buckets rewritten.

    ``order`` starts with the change time and is total per key; ``deleted`` names a boolean column
    (see :func:`~tidemark.operators.history.build_history`). ``buckets`` must stay the same for a
    path; choose it so that a bucket is some GB. A batch that is merged again changes nothing.
    """
    spark = batch.sparkSession
    layout = stored_layout(batch.schema)
    batch = settle(batch.withColumn(BUCKET, bucket_of(keys, buckets)), "history-batch", above=0)
    touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
    if not touched:
        return []
    old: list[str] = []
    if path_exists(spark, path):
        finish_swaps(spark, path)
        stored = spark.read.schema(stored_schema(layout, [BUCKET])).parquet(path)
        old = touched_files(stored.filter(F.col(BUCKET).isin(touched)))
    stored = read_files(spark, path, stored_schema(layout, [BUCKET]), old)
    named = batch.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    named = broadcast_if_small(settle(named, "touched-keys", above=0))
    same = _same_key(keys, "_of_")
    others = stored.join(named, same, "left_anti")
    own = stored.join(named, same, "left_semi").select(*batch.columns)
    versions = _versions(own.unionByName(batch), keys, order, state, deleted, rows_per_task)
    rows = others.unionByName(versions.select(*others.columns))
    replace_files(spark, path, old, rows, [BUCKET])
    return touched


def read_history(spark: SparkSession, path: str, columns: T.StructType, deleted: str | None = None) -> DataFrame:
    """The versions: rows that open one and are no delete. ``columns`` are those of the changes."""
    stored = spark.read.schema(stored_schema(stored_layout(columns), [BUCKET])).parquet(path)
    versions = stored.filter(OPENS)
    if deleted:
        versions = versions.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
    return versions.drop(OPENS, BUCKET)
