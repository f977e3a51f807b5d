"""Change-data-capture rows: decoding, state as of a time, differences, keyed changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.casts import epoch_millis, safe_cast, with_parsed_json
from tidemark.operators.ranking import latest_per_key

# Total order of the changes of one key.
CHANGE_ORDER = ("change_ts", "lsn", "bronze_partition", "bronze_offset")


def _as_text(table: T.StructType) -> T.StructType:
    """The same fields as text: each value is cast on its own, so one bad value spoils no other."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in table.fields])


def decode_changes(bronze: DataFrame, table: T.StructType) -> DataFrame:
    """Bronze change rows to typed rows, parsing each payload once.

    The row image is chosen once by the operation: ``before`` for deletes, else ``after``,
    else the payload itself for rows without an envelope. A field changed to NULL stays NULL.
    """
    text = _as_text(table)
    envelope = T.StructType(
        [
            T.StructField("before", text),
            T.StructField("after", text),
            T.StructField("source", T.StructType([T.StructField("lsn", T.StringType())])),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.StringType()),
            *text.fields,
        ]
    )
    lineage = bronze.select(
        "json_payload",
        "event_time",
        F.col("partition").alias("bronze_partition"),
        F.col("offset").alias("bronze_offset"),
    )
    parsed = with_parsed_json(lineage, "json_payload", envelope, "_e").drop("json_payload")
    envelope_column = F.col("_e")
    flat = F.struct(*[envelope_column[f.name].alias(f.name) for f in table.fields])
    image = (
        F.when(envelope_column["op"] == "d", envelope_column["before"])
        .when(envelope_column["after"].isNotNull(), envelope_column["after"])
        .when(envelope_column["before"].isNotNull(), envelope_column["before"])
        .when(envelope_column["op"].isNull(), flat)
    )
    return parsed.withColumn("_image", image).select(
        *[safe_cast(F.col("_image")[f.name], f.dataType).alias(f.name) for f in table.fields],
        F.coalesce(envelope_column["op"], F.lit("r")).alias("op"),
        F.coalesce(envelope_column["op"] == "d", F.lit(False)).alias("is_delete"),
        F.coalesce(epoch_millis(envelope_column["ts_ms"]), F.col("event_time")).alias("change_ts"),
        safe_cast(envelope_column["source"]["lsn"], "bigint").alias("lsn"),
        "event_time",
        "bronze_partition",
        "bronze_offset",
    )


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def state_as_of(
    changes: DataFrame,
    keys: Sequence[str],
    at: Column,
    order: Sequence[str] = CHANGE_ORDER,
    deleted: str = "is_delete",
) -> DataFrame:
    """The table as it stood at a time: latest image per key, deleted keys left out."""
    seen = changes.filter(F.col(order[0]) <= at)
    return latest_per_key(seen, keys, order).filter(~F.col(deleted))


def state_difference(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Keys added, removed or changed between two states with unique keys."""
    old = before.select(*keys, F.struct(*columns).alias("old"))
    new = after.select(*keys, F.struct(*columns).alias("new"))
    both = old.join(new, list(keys), "full")
    kind = (
        F.when(F.col("old").isNull(), F.lit("added"))
        .when(F.col("new").isNull(), F.lit("removed"))
        .when(~F.col("old").eqNullSafe(F.col("new")), F.lit("changed"))
    )
    return both.withColumn("change", kind).filter(F.col("change").isNotNull())


def change_summary(changes: DataFrame, keys: Sequence[str], batch: Column) -> DataFrame:
    """Changes per key and batch, with the deletes among them."""
    return changes.groupBy(*keys, batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if("is_delete").alias("deletes"),
        F.min("change_ts").alias("first_change"),
        F.max("change_ts").alias("last_change"),
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert new keys and replace existing ones; the newest row by ``order`` wins.

    On equal ``order`` an update beats the stored row.
    """
    tagged = target.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
    return latest_per_key(tagged, keys, [*order, "_update"]).drop("_update")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay: those for which the condition is false or unknown."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """SQL UPDATE: all assignments see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({n: F.when(hit, v).otherwise(F.col(n)) for n, v in assignments.items()})
