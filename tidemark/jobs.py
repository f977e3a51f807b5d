"""Jobs for spark-submit: ``python -m tidemark.jobs <job> ...``.

``ingest-events`` takes all waiting records of shared topics into one bronze table,
``ingest-cdc`` those of one captured table into its own; ``build-silver`` builds chosen
tables of the star schema; ``compact`` merges small files, ``retain`` removes old rows. Of a
catalog table (``--table``) both replace just the files concerned, so that it goes on being
written; of a folder (``--path``) they write another one and show it under a view's name, if one
is given, once its rows are checked.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import upkeep
from tidemark.plans import star
from tidemark.plans.dimensions import CALENDAR_FIRST, CALENDAR_LAST
from tidemark.schemas import BRONZE, QUARANTINE
from tidemark.session import build_session, has_source
from tidemark.sources import topics
from tidemark.sources.files import has_stream_log, is_table, refresh_table, table_location, table_partitions
from tidemark.sources.tables import ensure_schema, ensure_table, publish, read_table, write_snapshot
from tidemark.streaming import ingest

# Default names and batch sizes of the bronze and silver layers.
RAW_EVENTS = "bronze.raw_events"
CDC_PREFIX = "demo_public_"
EVENT_BATCH = 50_000
CDC_BATCH = 5_000


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark.jobs", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)
    for name, batch in (("ingest-events", EVENT_BATCH), ("ingest-cdc", CDC_BATCH)):
        job = jobs.add_parser(name)
        job.add_argument("--topics" if name == "ingest-events" else "--topic", dest="topics", required=True)
        job.add_argument("--bootstrap", default="kafka:9092")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--batch-size", type=int, default=batch, help="records per micro-batch")
        job.add_argument("--starting-offsets", default="latest", choices=["earliest", "latest"])
        job.add_argument("--avro-schemas", help="table or folder with schema_id and schema of Avro bodies")
        job.add_argument("--json-bodies", action="store_true", help="framed bodies are JSON")
        job.add_argument("--quarantine", help="table of records that do not decode; default: <table>_quarantine")
        job.add_argument("--table", default=RAW_EVENTS if name == "ingest-events" else None, required=name == "ingest-cdc")
    job = jobs.add_parser("build-silver")
    job.add_argument("--tables", default="all", help="comma list of table names")
    job.add_argument("--root", required=True, help="folder for table versions")
    job.add_argument("--bronze-schema", default="bronze")
    job.add_argument("--silver-schema", default="silver")
    job.add_argument("--calendar-first", default=CALENDAR_FIRST, help="first day of dim_date")
    job.add_argument("--calendar-last", default=CALENDAR_LAST, help="last day of dim_date")
    job = jobs.add_parser("compact")
    job.add_argument("--path")
    job.add_argument("--staged-path")
    job.add_argument("--partition-by", default="event_source")
    job.add_argument("--target-bytes", type=int, default=upkeep.TARGET_FILE_BYTES)
    job.add_argument("--table", help="catalog table to keep in place, or a view to show the new folder")
    job = jobs.add_parser("retain")
    job.add_argument("--path")
    job.add_argument("--staged-path")
    job.add_argument("--partition-by", default="event_source")
    job.add_argument("--keys", required=True, help="comma list; the newest row of each key stays")
    job.add_argument("--order", required=True, help="comma list, the time first")
    job.add_argument("--before", required=True, help="rows older than this time go")
    job.add_argument("--table", help="catalog table to keep in place, or a view to show the new folder")
    return root


def body_schemas(spark: SparkSession, args: argparse.Namespace) -> dict:
    """How bodies are decoded. Without a decoder every payload would be NULL, so that is refused."""
    if args.avro_schemas:
        if not has_source(spark, "avro"):
            raise RuntimeError("Avro bodies need the spark-avro package on the class path")
        rows = read_table(spark, args.avro_schemas).select("schema_id", "schema").distinct()
        return {"avro_schemas": {r["schema_id"]: r["schema"] for r in rows.collect()}}  # a registry: few rows
    if not args.json_bodies:
        raise ValueError("name --avro-schemas or --json-bodies: no decoder fits otherwise")
    return {}


def ingest_topics(spark: SparkSession, args: argparse.Namespace) -> None:
    schemas = body_schemas(spark, args)
    quarantine = args.quarantine or f"{args.table}_quarantine"
    ensure_table(spark, args.table, BRONZE)
    ensure_table(spark, quarantine, QUARANTINE, ("topic",))
    ingest.replay_is_ignored(spark, args.checkpoint, args.starting_offsets)
    spark.streams.addListener(ingest.ProgressLog())
    records = topics.stream_broker(
        spark,
        args.topics,
        args.bootstrap,
        starting_offsets=args.starting_offsets,
        records_per_trigger=args.batch_size,
    )
    ingest.ingest_available(records, args.table, args.checkpoint, quarantine, **schemas)


def silver_inputs(
    spark: SparkSession,
    tables: Sequence[star.StarTable],
    bronze: str,
    silver: str,
    first: str = CALENDAR_FIRST,
    last: str = CALENDAR_LAST,
) -> dict[str, DataFrame]:
    """Bronze feeds of the chosen tables, and dimensions of earlier runs they depend on."""
    chosen = {t.name for t in tables}
    inputs: dict[str, DataFrame] = {}
    for feed in {f for t in tables for f in t.feeds}:
        if feed == "calendar_bounds":
            inputs[feed] = spark.sql(f"SELECT DATE'{first}' AS first, DATE'{last}' AS last")
        elif feed == "raw_events":
            inputs[feed] = spark.table(f"{bronze}.raw_events")
        else:
            inputs[feed] = spark.table(f"{bronze}.{CDC_PREFIX}{feed}")
    for name in {d for t in tables for d in t.depends_on} - chosen:
        inputs[name] = spark.table(f"{silver}.{name}")
    return inputs


def build_silver(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = star.in_build_order(args.tables)
    ensure_schema(spark, args.silver_schema)
    inputs = silver_inputs(
        spark, tables, args.bronze_schema, args.silver_schema, args.calendar_first, args.calendar_last
    )
    version = f"{args.root.rstrip('/')}/{uuid.uuid4().hex}"
    star.build_star(spark, inputs, version, [t.name for t in tables], schema=args.silver_schema)


def _stored_table(spark: SparkSession, args: argparse.Namespace) -> tuple[str, list[str]] | None:
    """Folder and partition columns of the catalog table that a job is to keep, if it is one."""
    if not args.table or not is_table(spark, args.table):
        if not args.path or not args.staged_path:
            raise ValueError("name a catalog table, or --path and --staged-path")
        return None
    path = table_location(spark, args.table)
    if has_stream_log(spark, path):
        raise ValueError(f"{args.table} has a file sink's log, which names its files; ingest into a table without one")
    return path, table_partitions(spark, args.table)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    if stored := _stored_table(spark, args):
        upkeep.compact_binpack(spark, stored[0], spark.table(args.table).schema, stored[1], args.target_bytes)
        refresh_table(spark, args.table)
        return
    partition_by = _names(args.partition_by)
    stored = upkeep.compact(spark, args.path, args.staged_path, partition_by, args.target_bytes)
    if stored.count() != spark.read.parquet(args.path).count():
        raise RuntimeError(f"{args.staged_path} does not hold the rows of {args.path}")
    if args.table:
        publish(spark, args.table, args.staged_path, stored.schema)


def retain(spark: SparkSession, args: argparse.Namespace) -> None:
    cutoff = F.lit(args.before).cast("timestamp")
    keys, order = _names(args.keys), _names(args.order)
    if stored := _stored_table(spark, args):
        upkeep.retain_stored(spark, stored[0], spark.table(args.table).schema, stored[1], keys, order, cutoff)
        refresh_table(spark, args.table)
        return
    rows = spark.read.parquet(args.path)
    kept = upkeep.retain_recent(rows, keys, order, cutoff)
    stored = write_snapshot(kept, args.staged_path, _names(args.partition_by))
    recent = F.col(order[0]).isNull() | (F.col(order[0]) >= cutoff)
    if stored.filter(recent).count() != rows.filter(recent).count():
        raise RuntimeError(f"{args.staged_path} does not hold the recent rows of {args.path}")
    if args.table:
        publish(spark, args.table, args.staged_path, stored.schema)


def _names(text: str) -> list[str]:
    return [c for c in text.split(",") if c]


JOBS = {
    "ingest-events": ingest_topics,
    "ingest-cdc": ingest_topics,
    "build-silver": build_silver,
    "compact": compact,
    "retain": retain,
}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    JOBS[args.job](spark or build_session(f"tidemark:{args.job}"), args)


if __name__ == "__main__":
    main()
