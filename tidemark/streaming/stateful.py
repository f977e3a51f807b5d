"""Stateful stream operators and lateness reports."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upkeep import only_new_records
from tidemark.workspace import path_exists

# Fixed value: how late the event contract allows an event to be.
ALLOWED_LATENESS = "25 minutes"


@contextmanager
def disk_backed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB instead of executor memory."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def deduplicate(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Each key once, as long as its copies arrive within the allowed lateness.

    State is dropped once the watermark has passed, so it stays bounded on endless streams, and
    rows older than the watermark are dropped with it. Send those to a side table first
    (:func:`split_late`); for bounded catch-up use :func:`start_append_once`, which loses none.
    """
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


def start_append_once(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append each key once, whenever its copies arrive: nothing is late, so nothing is lost.

    Each batch is compared with the identities stored by the batches before it and written to a
    folder of its own, which a repeated batch replaces.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(list(keys))
        if number and path_exists(spark, path):
            layout = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in batch.select(*keys).schema)}, batch long"
            stored = spark.read.schema(layout).parquet(path).filter(F.col("batch") < number)
            fresh = only_new_records(fresh, stored, keys)
        writer = fresh.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def tumbling_counts(rows: DataFrame, event_time: str, by: Sequence[str], width: str = "1 day") -> DataFrame:
    return rows.groupBy(F.window(event_time, width)["start"].alias("window_start"), *by).agg(
        F.count(F.lit(1)).alias("rows")
    )


def start_partial_counts(
    stream: DataFrame, event_time: str, by: Sequence[str], path: str, checkpoint: str, width: str = "1 day"
) -> StreamingQuery:
    """Window counts of each batch into a folder of its own; ``merged_counts`` adds them up.

    A batch that is run again after a failure replaces its own folder, so every record
    counts exactly once, however late it is.
    """

    def keep(batch: DataFrame, number: int) -> None:
        counts = tumbling_counts(batch, event_time, by, width)
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged_counts(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    parts = spark.read.parquet(path)
    return parts.groupBy("window_start", *by).agg(F.sum("rows").alias("rows"))


def is_late(event_time: Column, ingest_time: Column, minutes: int = 25) -> Column:
    """Arrived later than the contract allows."""
    return F.unix_micros(ingest_time) - F.unix_micros(event_time) > minutes * 60_000_000


def split_late(rows: DataFrame, event_time: str, ingest_time: str, minutes: int = 25) -> tuple[DataFrame, DataFrame]:
    """Rows in time, and late rows for a side table."""
    late = F.coalesce(is_late(F.col(event_time), F.col(ingest_time), minutes), F.lit(False))
    return rows.filter(~late), rows.filter(late)


def ingest_lag(rows: DataFrame, event_time: str, ingest_time: str, by: Sequence[str]) -> DataFrame:
    """Whole seconds between event and ingest per group, with exact percentiles.

    Equal lags are counted first, so a group is merged from one row per distinct second,
    however many events it has.
    """
    lag = F.floor((F.unix_micros(ingest_time) - F.unix_micros(event_time)) / F.lit(1_000_000))
    counted = rows.groupBy(*by, lag.alias("lag_s")).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.groupBy(*by).agg(
        F.sum("_rows").alias("rows"),
        F.min("lag_s").alias("min_lag_s"),
        F.percentile("lag_s", 0.5, F.col("_rows")).alias("median_lag_s"),
        F.percentile("lag_s", 0.95, F.col("_rows")).alias("p95_lag_s"),
        F.max("lag_s").alias("max_lag_s"),
    )
