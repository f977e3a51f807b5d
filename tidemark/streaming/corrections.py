"""Window counts given out by a watermark, and corrections for what came after.

The stream counts rows per window and gives a window out once, when the watermark has passed its end.
Rows that come later are dropped there; a query of its own notes their windows in a side table. A
window that was given out and is touched by such a row gets two corrections: its old count is
retracted and the count over all stored rows is added. Windows that are still open are added as they
stand. What was given out and the corrections sum up to the counts of all rows, at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.settle import settle
from tidemark.streaming.ingest import start_append
from tidemark.workspace import path_exists

START = "window_start"


def _note_late(path: str, event_time: str, by: Sequence[str], width: str, lateness: str):
    """Windows of rows that came when the newest row of earlier batches, less the lateness, was behind their end."""
    newest = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("batch", T.LongType())])

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = settle(batch.filter(F.col(event_time).isNotNull()).select(event_time, *by), "late-check")
        if path_exists(spark, f"{path}/newest"):
            seen = spark.read.schema(newest).parquet(f"{path}/newest").filter(F.col("batch") < number)
            top = seen.agg(F.date_format(F.max("newest"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
            mark = F.lit(top).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
            window = F.window(event_time, width)
            placed = rows.select(window["start"].alias(START), window["end"].alias("_end"), *by)
            late = placed.filter(F.col("_end") <= mark)
            late.groupBy(START, *by).agg(F.count(F.lit(1)).alias("late_rows")).write.mode("overwrite").parquet(
                f"{path}/late/batch={number}"
            )
        rows.agg(F.max(event_time).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={number}")

    return keep


def start_window_counts(
    stream: DataFrame,
    event_time: str,
    by: Sequence[str],
    path: str,
    checkpoint: str,
    width: str = "1 day",
    lateness: str = "25 minutes",
    fine: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """Take all waiting rows and stop. ``fine`` is the same stream in batches of one file, by which
    lateness is judged; without it ``stream`` is taken to be such a stream."""
    timed = stream.withWatermark(event_time, lateness)
    # grouped by the window itself: its start alone does not carry the watermark
    counts = timed.groupBy(F.window(event_time, width).alias("_window"), *by).agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.select(F.col("_window.start").alias(START), *by, "rows")
    given = start_append(counts, f"{path}/given", f"{checkpoint}/given", partition_by=())
    notes = (stream if fine is None else fine).writeStream.foreachBatch(_note_late(path, event_time, by, width, lateness))
    late = notes.option("checkpointLocation", f"{checkpoint}/late").trigger(availableNow=True).start()
    return {"given": given, "late": late}


def given_counts(spark: SparkSession, path: str, columns: T.StructType, by: Sequence[str]) -> DataFrame:
    """Windows that the stream gave out."""
    layout = T.StructType([T.StructField(START, T.TimestampType()), *(columns[c] for c in by), T.StructField("rows", T.LongType())])
    if not path_exists(spark, f"{path}/given/_spark_metadata"):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(f"{path}/given")


def late_rows(spark: SparkSession, path: str, columns: T.StructType, by: Sequence[str]) -> DataFrame:
    """The side table: windows and how many rows came late for them."""
    layout = T.StructType([T.StructField(START, T.TimestampType()), *(columns[c] for c in by), T.StructField("late_rows", T.LongType())])
    if not path_exists(spark, f"{path}/late"):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(f"{path}/late")


def corrections(
    spark: SparkSession, stored: DataFrame, event_time: str, by: Sequence[str], path: str, watermark: str | None, width: str = "1 day"
) -> DataFrame:
    """``correction`` (retract, add), window, ``by`` and ``rows``, negative where retracted.

    ``stored`` holds all rows; only those of windows that are open or had late rows are counted.
    """
    keys = [START, *by]
    given = given_counts(spark, path, stored.schema, by)
    late = late_rows(spark, path, stored.schema, by).select(START).distinct()
    late = settle(late, "late-windows", above=0)
    window = F.window(event_time, width)
    placed = stored.select(window["start"].alias(START), window["end"].alias("_end"), *by)
    open_ = F.lit(watermark is None) | (F.col("_end") > F.lit(watermark).cast("timestamp"))
    marked = placed.join(late.withColumn("_late", F.lit(True)), START, "left")
    touched = marked.filter(open_ | F.col("_late"))
    added = touched.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    windows = settle(touched.select(START).distinct(), "touched-windows", above=0)
    retracted = given.join(windows, START, "left_semi").withColumn("rows", -F.col("rows"))
    both = [retracted.withColumn("correction", F.lit("retract")), added.withColumn("correction", F.lit("add"))]
    return both[0].unionByName(both[1]).select("correction", *keys, "rows")


def summed(given: DataFrame, corrected: DataFrame, by: Sequence[str]) -> DataFrame:
    """What readers see: counts given out with all corrections applied."""
    whole = given.unionByName(corrected.drop("correction"))
    return whole.groupBy(START, *by).agg(F.sum("rows").alias("rows")).filter("rows <> 0")
