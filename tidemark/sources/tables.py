"""Tables: scans, snapshots, appends, schemas and partitioned tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet folder if the name is a path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def spread_rows(df: DataFrame, *by: str) -> DataFrame:
    """Give every core work when a table has fewer splits than there are cores.

    A file with one row group is one task. Before costly per-row work such as parsing, its
    rows are hashed over all cores. Tables with enough splits stay as they are.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def _gather(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather rows of a partition for writing, splitting large ones at run time."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_snapshot(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), codec: str = "zstd"
) -> DataFrame:
    """Create or replace a table at a path and read it back."""
    writer = _gather(df, partition_by).write.mode("overwrite").option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(_stored(df, partition_by)).parquet(path)


def _stored(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name not in partition_by]
    return T.StructType(fields + [df.schema[c] for c in partition_by])


def side_by_side(tasks: Sequence[Callable[[], DataFrame]], at_once: int = 4) -> list[DataFrame]:
    """Run independent builds at the same time, so one's last tasks overlap the next one's."""
    with_properties = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(with_properties(task)) for task in tasks]
        return [r.result() for r in running]


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = _gather(df, partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[Column] = (), provider: str = "parquet") -> None:
    """Create or replace through a catalog that supports it (table formats)."""
    writer = df.writeTo(table).using(provider)
    if partition_by:
        writer = writer.partitionedBy(*partition_by)
    writer.createOrReplace()


def with_month(df: DataFrame, day: str, name: str = "month_start") -> DataFrame:
    """Month of a date as a column to partition by."""
    return df.withColumn(name, F.trunc(F.col(day).cast("date"), "MM"))


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def ensure_table(
    spark: SparkSession,
    table: str,
    columns: T.StructType,
    partition_by: Sequence[str] = ("event_source",),
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
    provider: str = "parquet",
) -> None:
    """Create the schema and the partitioned table if they do not exist."""
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING {provider}"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        statement += f" LOCATION '{location}'"
    if properties:
        pairs = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def publish(spark: SparkSession, table: str, path: str, columns: T.StructType) -> None:
    """Make a finished, checked path what readers of a name see; they see old or new, never half.

    A name is a view over one path, replaced in one catalog step. So schema and layout may change
    from run to run, and no partition of an earlier run can stay behind. An external table of that
    name from before is dropped once and its files stay; a managed one would lose its files, so it is
    refused.
    """
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])
    _refuse_managed(spark, table)
    if spark.catalog.tableExists(table) and not _is_view(spark, table):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {_typed(columns)} FROM parquet.`{path}`")


def publish_together(spark: SparkSession, schema: str, finished: Mapping[str, tuple[str, T.StructType]]) -> None:
    """Publish the finished paths of several names of a schema so that all of them change in one catalog step.

    Each name first becomes a view over its old rows and its new ones, of which a one-row view,
    ``<schema>.switched_runs``, lets through one side: it lists the calls that are past their switch.
    Replacing it switches all names. Then each name becomes a plain view of its new path and the call
    leaves the list. A failure before the switch leaves all names old, one after it leaves all new; later
    calls take over from either, for any choice of names. Old rows have the new columns meanwhile, NULL
    where they lack one. An external table becomes a view of its folder before the switch. One call at a
    time may publish in a schema.
    """
    ensure_schema(spark, schema)
    pointer, run = f"{schema}.switched_runs", uuid.uuid4().hex
    names = {name: f"{schema}.{name}" for name in finished}
    for table in (*names.values(), pointer):
        _refuse_managed(spark, table)
    if spark.catalog.tableExists(pointer):
        switched = list(spark.table(pointer).first()[0])
    else:
        _list_runs(spark, pointer, switched := [])
    is_new = f"(SELECT array_contains(runs, '{run}') FROM {pointer})"
    for name, (path, columns) in finished.items():
        table = names[name]
        view = f"SELECT {_typed(columns)} FROM parquet.`{path}` WHERE {is_new}"
        if spark.catalog.tableExists(table):
            # what the name shows now, as a query of its own: a view cannot read itself
            if _is_view(spark, table):
                shown = spark.sql(f"SHOW CREATE TABLE {table}").first()[0].split("\nAS ", 1)[1]
            else:
                shown = f"SELECT * FROM parquet.`{_location(spark, table)}`"
            old = {c.lower() for c in spark.table(table).columns}
            kept = ", ".join(
                f"CAST({f'`{f.name}`' if f.name.lower() in old else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in columns.fields
            )
            view = f"SELECT {kept} FROM ({shown}) WHERE NOT {is_new} UNION ALL {view}"
            if not _is_view(spark, table):
                spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS {view}")
    _list_runs(spark, pointer, [*switched, run])
    for name, (path, columns) in finished.items():
        publish(spark, names[name], path, columns)
    _list_runs(spark, pointer, switched)


def _list_runs(spark: SparkSession, pointer: str, runs: Sequence[str]) -> None:
    listed = ", ".join(f"'{run}'" for run in runs)
    spark.sql(f"CREATE OR REPLACE VIEW {pointer} AS SELECT CAST(array({listed}) AS array<string>) AS runs")


def _typed(columns: T.StructType) -> str:
    return ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns.fields)


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _refuse_managed(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType not in ("VIEW", "EXTERNAL"):
        raise ValueError(f"{table} is a managed table: a view of that name would cost its files")


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def drop_table(spark: SparkSession, table: str) -> None:
    view = spark.catalog.tableExists(table) and _is_view(spark, table)
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {table}")


def drop_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
