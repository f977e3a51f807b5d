"""Reading the tables, staging rows and spreading work; shared by the operators."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import workspace

# Word separators of every contract: space and the five ASCII controls from tab to carriage return.
SPACES = "\t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    Cuts the lineage: an executor lost later costs its running tasks, not the passes before.
    """
    path = workspace.fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when the input has fewer splits than cores and is worth splitting."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits >= cores else df.repartition(cores)


HASH_STEPS = 1 << 40


def hash_place(key: str) -> Column:
    """A key's place in a fixed shuffled order."""
    return F.pmod(F.xxhash64(key), F.lit(HASH_STEPS))


def hash_share(key: str, share: Column) -> Column:
    """Whether a row belongs to about the given share of keys, by hash."""
    return hash_place(key) < share * F.lit(float(HASH_STEPS))


def least_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most so many rows, those of smallest hash of the key.

    About twice as many pass a cut of the hash first, so that no task sorts more than that,
    however many tasks the rows come from.
    """
    total = rows.count()
    near = rows.filter(hash_share(key, F.lit(2.0 * most / total))) if total > 2 * most else rows
    return near.orderBy(hash_place(key), *near.columns).limit(most)


def in_fold(column: Column | str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's decimal text leaves the remainder, as the folds of the contracts are cut.

    A row without id is in no such fold.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


_shipped: set[str] = set()


# Rows of an Arrow batch: some MB of text, however many rows a partition has.
BATCH_ROWS = 2_500


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on the executors, and keep
    the batches they get small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
