"""Relational tables over JDBC, read and written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC read; with a split column the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if split_column:
        if bounds is None:
            raise ValueError("a split column needs its bounds")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_relational(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def write_relational(
    df: DataFrame, url: str, table: str, *, mode: str = "append", connections: int = 16, batch_size: int = 10_000, **properties: str
) -> None:
    """Write a table; at most ``connections`` tasks hold a connection at a time."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, numPartitions=str(connections), batchsize=str(batch_size), **properties)
        .mode(mode)
        .save()
    )
