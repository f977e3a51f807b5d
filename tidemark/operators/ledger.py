"""Which offsets are stored, as ranges: a ledger beside a table.

Offsets of a topic partition come nearly in a row, so what is stored is a few ranges per (source,
partition), however many records there are. New records, gaps and counts are found from the ranges;
the stored rows are not read again.

Each batch has a number of its own. It writes its rows and its ranges to folders of that number, the
ranges last. A batch that is repeated replaces both, and reads the ranges of the other batches only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.operators.asof import asof_join
from tidemark.operators.settle import settle
from tidemark.workspace import path_exists

SOURCE = ("event_source", "partition")
OFFSET = "offset"
BATCH = "batch"
# Offsets of one block are coalesced within one array.
BLOCK = 4_096


def ranges_of(records: DataFrame, source: Sequence[str] = SOURCE, offset: str = OFFSET) -> DataFrame:
    """``first``, ``last`` of the runs of offsets per source; repeated offsets count once.

    Offsets meet in blocks of bounded size first, so a partition with very many of them is
    one row per block, or per gap, when its ranges are put together. NULL offsets have no range.
    """
    known = records.filter(F.col(offset).isNotNull())
    block = F.floor(F.col(offset) / F.lit(BLOCK))
    once = known.select(*source, F.col(offset).cast("long").alias("_o"), block.alias("_block")).distinct()
    blocks = once.groupBy(*source, "_block").agg(F.array_sort(F.collect_list("_o")).alias("_run"))
    run = F.col("_run")
    starts = F.filter(run, lambda o, i: (i == 0) | (F.get(run, i - 1) < o - 1))
    ends = F.filter(run, lambda o, i: F.coalesce(F.get(run, i + 1) > o + 1, F.lit(True)))
    rows = blocks.select(*source, F.explode(F.arrays_zip(starts.alias("first"), ends.alias("last"))).alias("r"))
    return union_ranges(rows.select(*source, "r.first", "r.last"), source)


def union_ranges(ranges: DataFrame, source: Sequence[str] = SOURCE) -> DataFrame:
    """Interval union per source: ranges that overlap or touch become one."""
    along = Window.partitionBy(*source).orderBy("first", "last")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = ranges.withColumn("_opens", (reach.isNull() | (F.col("first") > reach + 1)).cast("long"))
    numbered = opens.withColumn("_run", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*source, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def gaps(ranges: DataFrame, source: Sequence[str] = SOURCE) -> DataFrame:
    """Offsets that lack between the ranges of a union: ``after``, ``before`` and how many."""
    following = F.lead("first").over(Window.partitionBy(*source).orderBy("first"))
    rows = ranges.withColumn("before", following).filter("before is not null")
    return rows.select(*source, F.col("last").alias("after"), "before", (F.col("before") - F.col("last") - 1).alias("missing"))


def not_in(
    records: DataFrame,
    ranges: DataFrame,
    source: Sequence[str] = SOURCE,
    offset: str = OFFSET,
    strategy: str = "auto",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Records whose offset is in none of the ranges (a union), each offset once.

    A record's range is the last one that begins at or before its offset: an as-of join. Records
    without source or offset cannot be told from others and are kept, as they are.
    """
    complete = F.lit(True)
    for name in (*source, offset):
        complete = complete & F.col(name).isNotNull()
    known = ranges.select(*[F.col(c).alias(f"_of_{c}") for c in source], F.col("first").alias("valid_from"),
                          (F.col("last") + 1).alias("valid_to"), F.lit(True).alias("_known"))
    once = records.filter(complete).dropDuplicates([*source, offset]).withColumn("_at", F.col(offset).cast("long"))
    joined = asof_join(
        once, known, {c: f"_of_{c}" for c in source}, "_at", {"_known": "_stored"}, strategy=strategy, rows_per_task=rows_per_task
    )
    fresh = joined.filter("_stored is null").select(*records.columns)
    return fresh.unionByName(records.filter(~complete))


def read_ranges(
    spark: SparkSession, path: str, columns: T.StructType, source: Sequence[str] = SOURCE, without: int | None = None
) -> DataFrame:
    """The union of all batches' ranges, or of all but one. ``columns`` are those of the records."""
    layout = T.StructType(
        [*(columns[c] for c in source), *(T.StructField(n, T.LongType()) for n in ("first", "last", BATCH))]
    )
    folder = f"{path.rstrip('/')}/ranges"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], layout).drop(BATCH)
    ranges = spark.read.schema(layout).parquet(folder)
    if without is not None:
        ranges = ranges.filter(F.col(BATCH) != without)
    return union_ranges(ranges.drop(BATCH), source)


def read_rows(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Rows of the batches that are finished: those with ranges."""
    folder = path.rstrip("/")
    layout = T.StructType([*columns.fields, T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, f"{folder}/ranges"):
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(layout).parquet(f"{folder}/rows")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/ranges")
    listed = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    names = [s.getPath().getName() for s in listed if path_exists(spark, f"{s.getPath()}/_SUCCESS")]
    finished = [int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")]
    return rows.filter(F.col(BATCH).isin(finished)).drop(BATCH)


def append_new(
    records: DataFrame, batch: int, path: str, source: Sequence[str] = SOURCE, offset: str = OFFSET
) -> None:
    """Append the records that are not stored yet, and enter their offsets."""
    spark = records.sparkSession
    folder = path.rstrip("/")
    stored = read_ranges(spark, folder, records.schema, source, without=batch)
    rows = f"{folder}/rows/{BATCH}={batch}"
    not_in(settle(records, "ledger-batch"), stored, source, offset).write.mode("overwrite").parquet(rows)
    written = spark.read.schema(records.schema).parquet(rows)
    ranges_of(written, source, offset).write.mode("overwrite").parquet(f"{folder}/ranges/{BATCH}={batch}")
