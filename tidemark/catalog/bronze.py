"""Registered queries: ingestion, raw rows, wire format, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import workspace
from tidemark.catalog import stand_ins
from tidemark.catalog.registry import query
from tidemark.catalog.stand_ins import table
from tidemark.functions import casts, wire
from tidemark.operators import decode, payloads
from tidemark.operators.changes import state_difference
from tidemark.operators.quality import offset_faults
from tidemark.operators import ledger
from tidemark.operators.ranking import first_n_per_key, newest_rows
from tidemark.plans import facts
from tidemark.plans.dimensions import calendar_of
from tidemark.schemas import QUARANTINE
from tidemark.sources import topics
from tidemark.sources.tables import write_snapshot
from tidemark.streaming import corrections, ingest, lifecycle, stateful

# ---- streams -------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return topics.stream_files(spark, sf_dir, schema=schema, file_glob=f"{name}.parquet")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_ins.topic_records(_stream(spark, sf_dir, "events"))


def _by_source(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("event_source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.sum(F.col("payload_size").cast("bigint")).alias("payload_bytes"),
        F.count("json_payload").alias("decoded"),
    )


_INGEST_SQL = """
SELECT event_type AS event_source, count(*) AS rows, min(event_id // 3) AS min_offset,
       max(event_id // 3) AS max_offset, cast(sum(strlen(props)) AS bigint) AS payload_bytes,
       count(props) AS decoded
FROM events GROUP BY 1
"""


@query("bronze_ingest_multi", _INGEST_SQL)
def bronze_ingest_multi(spark, sf_dir):
    root = workspace.fresh_folder(spark, "ingest")
    ingest.ingest_available(_events_stream(spark, sf_dir), f"{root}/bronze", f"{root}/checkpoint")
    return _by_source(ingest.read_bronze(spark, f"{root}/bronze"))


@query(
    "bronze_ingest_cdc",
    """
SELECT 'demo.public.customer_segments' AS event_source, count(*) AS rows, min(o_orderkey) AS min_offset,
       max(o_orderkey) AS max_offset, count(*) FILTER (o_orderkey % 41 = 0) AS deletes
FROM orders
""",
)
def bronze_ingest_cdc(spark, sf_dir):
    root = workspace.fresh_folder(spark, "ingest-cdc")
    changes = stand_ins.segment_changes(_stream(spark, sf_dir, "orders"))
    ingest.start_append(changes, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    bronze = ingest.read_bronze(spark, f"{root}/bronze")
    return bronze.groupBy("event_source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count_if(F.get_json_object("json_payload", "$.op") == "d").alias("deletes"),
    )


@query("bronze_idempotent_append", _INGEST_SQL)
def bronze_idempotent_append(spark, sf_dir):
    root = workspace.fresh_folder(spark, "ingest-twice")
    for _ in range(2):
        ingest.ingest_available(_events_stream(spark, sf_dir), f"{root}/bronze", f"{root}/checkpoint")
    return _by_source(ingest.read_bronze(spark, f"{root}/bronze"))


@query(
    "replay_equals_first_run",
    "SELECT event_type AS event_source, count(*) AS rows, 0::bigint AS differing FROM events GROUP BY 1",
)
def replay_equals_first_run(spark, sf_dir):
    root = workspace.fresh_folder(spark, "replay")
    for run in ("first", "second"):
        ingest.ingest_available(_events_stream(spark, sf_dir), f"{root}/{run}", f"{root}/{run}-checkpoint")
    first, second = (ingest.read_bronze(spark, f"{root}/{run}") for run in ("first", "second"))
    identity = ["event_source", "partition", "offset"]
    changed = state_difference(
        first, second, identity, ["event_time", "schema_id", "payload_size", "json_payload"]
    )
    rows = first.select("event_source", F.lit(1).alias("n"), F.lit(0).alias("d")).unionByName(
        changed.select("event_source", F.lit(0).alias("n"), F.lit(1).alias("d"))
    )
    return rows.groupBy("event_source").agg(F.sum("n").alias("rows"), F.sum("d").alias("differing"))


@query(
    "stream_dedup",
    """
SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS distinct_ids,
       cast(sum(cast(value AS decimal(18,2))) AS double) AS total_value
FROM events GROUP BY 1
""",
)
def stream_dedup(spark, sf_dir):
    root = workspace.fresh_folder(spark, "dedup")
    events = _stream(spark, sf_dir, "events")
    stateful.start_append_once(events.union(events), f"{root}/rows", f"{root}/checkpoint", ["event_id"]).awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("event_id").alias("distinct_ids"),
        casts.exact_sum(F.col("value")).cast("double").alias("total_value"),
    )


@query(
    "stream_window_corrections",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS rows FROM events GROUP BY 1, 2
""",
)
def stream_window_corrections(spark, sf_dir):
    """Daily counts by a watermark over five files in mixed order, with retractions for late rows."""
    root = workspace.fresh_folder(spark, "window-corrections")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    ids = events.agg(F.max("event_id")).first()[0] or 0
    fifth = F.floor(F.col("event_id") * 5 / F.lit(ids + 1))
    for part in (1, 0, 3, 2, 4):
        events.filter(fifth == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    by = ["event_type"]
    queries = corrections.start_window_counts(stream, "ts", by, f"{root}/out", f"{root}/checkpoint")
    for started in queries.values():
        started.awaitTermination()
    mark = lifecycle.watermark_of([queries["given"]])
    fixes = corrections.corrections(spark, events, "ts", by, f"{root}/out", mark)
    counts = corrections.summed(corrections.given_counts(spark, f"{root}/out", events.schema, by), fixes, by)
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "rows")


@query(
    "stream_tumbling_counts",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS rows
FROM events GROUP BY 1, 2
""",
)
def stream_tumbling_counts(spark, sf_dir):
    root = workspace.fresh_folder(spark, "tumbling")
    stateful.start_partial_counts(
        _stream(spark, sf_dir, "events"), "ts", ["event_type"], f"{root}/parts", f"{root}/checkpoint"
    ).awaitTermination()
    counts = stateful.merged_counts(spark, f"{root}/parts", ["event_type"])
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "rows")


# ---- raw rows ------------------------------------------------------------------------


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _records(spark, sf_dir, faulty: bool = False):
    value = stand_ins.faulty_props() if faulty else None
    return stand_ins.topic_records(_events(spark, sf_dir), value)


def _bronze(spark, sf_dir):
    return decode.to_bronze(_records(spark, sf_dir))


def _shown(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_time", casts.stamp(F.col("event_time")))


_BRONZE_SQL = """
SELECT event_type AS event_source, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, 17 AS schema_id,
       strlen(props) AS payload_size, props AS json_payload, event_id % 3 AS partition, event_id // 3 AS "offset"
FROM events
"""


@query("bronze_projection", _BRONZE_SQL)
def bronze_projection(spark, sf_dir):
    return _shown(_bronze(spark, sf_dir))


@query("topic_filter", _BRONZE_SQL + "WHERE event_type = 'purchase'")
def topic_filter(spark, sf_dir):
    return _shown(payloads.of_source(_bronze(spark, sf_dir), "purchase"))


@query(
    "partition_prune_source",
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, cast(sum(strlen(props)) AS bigint) AS payload_bytes
FROM events WHERE event_type = 'purchase' GROUP BY 1
""",
)
def partition_prune_source(spark, sf_dir):
    path = workspace.fresh_folder(spark, "by-source")
    stored = write_snapshot(_bronze(spark, sf_dir), path, ["event_source"])
    return (
        payloads.of_source(stored, "purchase")
        .groupBy(F.date_format("event_time", "yyyy-MM-dd").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("payload_size").cast("bigint")).alias("payload_bytes"))
    )


@query(
    "newest_events",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, event_type, user_id
FROM events ORDER BY ts DESC, event_id DESC LIMIT 20
""",
)
def newest_events(spark, sf_dir):
    newest = newest_rows(_events(spark, sf_dir), ["ts", "event_id"], 20)
    return newest.select("event_id", casts.stamp(F.col("ts")).alias("event_time"), "event_type", "user_id")


@query(
    "bronze_count_by_source_day",
    "SELECT event_type AS event_source, strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows FROM events GROUP BY 1, 2",
)
def bronze_count_by_source_day(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return bronze.groupBy("event_source", F.to_date("event_time").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("topic_message_count", "SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1")
def topic_message_count(spark, sf_dir):
    return topics.message_count(_records(spark, sf_dir))


@query(
    "offset_gaps",
    """
WITH rows AS (
  SELECT event_type, event_id % 3 AS partition, event_id // 3 AS o,
         lead(event_id // 3) OVER (PARTITION BY event_type, event_id % 3 ORDER BY event_id) AS n
  FROM events)
SELECT event_type AS event_source, partition, o AS "offset", n AS next_offset, n - o - 1 AS missing
FROM rows WHERE n - o - 1 <> 0
""",
)
def offset_gaps(spark, sf_dir):
    # numbers are dealt over all events, so those of one type have gaps
    rows = _events(spark, sf_dir).select(
        F.col("event_type").alias("event_source"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
    )
    return offset_faults(rows)


@query(
    "offset_ledger",
    """
WITH rows AS (SELECT event_type AS event_source, event_id % 3 AS partition, event_id // 3 AS o FROM events),
runs AS (SELECT *, o - row_number() OVER (PARTITION BY event_source, partition ORDER BY o) AS run FROM rows)
SELECT event_source, partition, min(o) AS "first", max(o) AS "last", count(*) AS stored, count(DISTINCT run) AS ranges,
       max(o) - min(o) + 1 - count(*) AS missing
FROM runs GROUP BY 1, 2
""",
)
def offset_ledger(spark, sf_dir):
    """Batches that overlap, in mixed order, one of them twice; then counts and gaps from the ranges alone."""
    path = workspace.fresh_folder(spark, "ledger")
    records = _events(spark, sf_dir).select(
        F.col("event_type").alias("event_source"), (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"), "props",
    )
    end = records.agg(F.max("offset")).first()[0] or 0
    place = F.col("offset") / F.lit(max(end, 1))
    for number, part in ((0, place >= 0.6), (1, place < 0.3), (2, place.between(0.2, 0.7)), (1, place < 0.3)):
        ledger.append_new(records.filter(part), number, path)
    ranges = ledger.read_ranges(spark, path, records.schema)
    lacking = ledger.gaps(ranges).groupBy(*ledger.SOURCE).agg(F.sum("missing").alias("missing"))
    stored = ledger.read_rows(spark, path, records.schema).groupBy(*ledger.SOURCE).agg(F.count(F.lit(1)).alias("stored"))
    seen = ranges.groupBy(*ledger.SOURCE).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.lit(1)).alias("ranges")
    )
    counted = seen.join(lacking, list(ledger.SOURCE), "left").join(stored, list(ledger.SOURCE))
    return counted.withColumn("missing", F.coalesce("missing", F.lit(0)))


@query(
    "topic_peek",
    """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT event_type AS topic, event_id % 3 AS partition, event_id // 3 AS "offset", cast(user_id AS varchar) AS key,
       strlen(props) + 5 AS size, substr('0000000011' || hex(encode(props)), 1, 40) AS preview, 17 AS schema_id
FROM ranked WHERE rn <= 5
""",
)
def topic_peek(spark, sf_dir):
    peek = first_n_per_key(_records(spark, sf_dir), ["topic"], ["timestamp", "offset", "partition"], 5)
    return peek.select(
        "topic",
        "partition",
        "offset",
        F.decode("key", "UTF-8").alias("key"),
        F.octet_length("value").alias("size"),
        wire.hex_preview(F.col("value")).alias("preview"),
        wire.schema_id(F.col("value")).alias("schema_id"),
    )


# ---- wire format ---------------------------------------------------------------------


@query(
    "wire_header",
    """
SELECT event_id,
       CASE WHEN event_id % 77 = 0 OR event_id % 50 = 0 THEN NULL ELSE 17 END AS schema_id,
       CASE WHEN event_id % 77 = 0 THEN 0 ELSE strlen(props) END AS payload_size
FROM events
""",
)
def wire_header(spark, sf_dir):
    value = stand_ins.faulty_props()
    return _events(spark, sf_dir).select(
        "event_id", wire.schema_id(value).alias("schema_id"), wire.payload_size(value).alias("payload_size")
    )


def _registered_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema ids that occur in the topics, kept as a registry table."""
    ids = _records(spark, sf_dir).select(wire.schema_id(F.col("value")).alias("schema_id")).distinct()
    return write_snapshot(ids, workspace.fresh_folder(spark, "registry"))


@query(
    "wire_decode_json",
    """
SELECT event_type AS topic, event_id % 3 AS partition, event_id // 3 AS "offset",
       cast(json_extract_string(props, '$.k') AS integer) AS k
FROM events WHERE event_id % 77 <> 0 AND event_id % 50 <> 0
""",
)
def wire_decode_json(spark, sf_dir):
    decoded = decode.decode_frames(_records(spark, sf_dir, faulty=True), json_schemas=_registered_schemas(spark, sf_dir))
    good, _ = decode.split_decoded(decoded)
    parsed = payloads.parse_payload(good, T.StructType([T.StructField("k", T.IntegerType())]))
    return parsed.select("topic", "partition", "offset", casts.safe_cast(F.col("payload.k"), "int").alias("k"))


@query(
    "wire_decode_quarantine",
    """
SELECT event_type AS topic,
       CASE WHEN event_id % 77 = 0 THEN 'short' WHEN event_id % 50 = 0 THEN 'bad_magic' ELSE 'decoded' END AS decode_status,
       count(*) AS rows
FROM events GROUP BY 1, 2
""",
)
def wire_decode_quarantine(spark, sf_dir):
    decoded = decode.decode_frames(_records(spark, sf_dir, faulty=True))
    return decoded.groupBy("topic", "decode_status").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "ingest_quarantine",
    """
SELECT event_type AS event_source, count(*) AS read_rows,
       count(*) FILTER (event_id % 77 <> 0 AND event_id % 50 <> 0) AS good,
       count(*) FILTER (event_id % 77 = 0 OR event_id % 50 = 0) AS quarantined,
       cast(sum(CASE WHEN event_id % 77 = 0 THEN 3 WHEN event_id % 50 = 0 THEN strlen(props) + 5 ELSE 0 END) AS bigint) AS kept_bytes
FROM events GROUP BY 1
""",
)
def ingest_quarantine(spark, sf_dir):
    root = workspace.fresh_folder(spark, "quarantine")
    faulty = stand_ins.topic_records(_stream(spark, sf_dir, "events"), stand_ins.faulty_props())
    ingest.ingest_available(faulty, f"{root}/bronze", f"{root}/checkpoint", quarantine=f"{root}/refused")
    bronze = ingest.read_bronze(spark, f"{root}/bronze").groupBy("event_source").agg(
        F.count(F.lit(1)).alias("read_rows"), F.count("json_payload").alias("good")
    )
    refused = spark.read.schema(QUARANTINE).parquet(f"{root}/refused").groupBy(F.col("topic").alias("event_source")).agg(
        F.count(F.lit(1)).alias("quarantined"), F.sum(F.octet_length("value").cast("bigint")).alias("kept_bytes")
    )
    return bronze.join(refused, "event_source", "left")


@query(
    "encoding_savings",
    """
WITH sizes AS (
  SELECT event_type, strlen(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'props': props})) AS j,
         strlen(props) + 5 + strlen(cast(user_id AS varchar)) AS b
  FROM events)
SELECT event_type AS event_source, cast(sum(j) AS bigint) AS json_bytes, cast(sum(b) AS bigint) AS binary_bytes,
       100.0::double * (sum(j) - sum(b))::double / sum(j)::double AS saved_percent
FROM sizes GROUP BY 1
""",
)
def encoding_savings(spark, sf_dir):
    # bytes of the row as JSON, and of the framed message with its key as it is carried
    text = F.octet_length(F.to_json(F.struct("event_id", "user_id", "event_type", "props")))
    events = _events(spark, sf_dir).groupBy(F.col("event_type").alias("event_source")).agg(
        F.sum(text.cast("bigint")).alias("json_bytes")
    )
    carried = (F.octet_length("value") + F.octet_length("key")).cast("bigint")
    messages = _records(spark, sf_dir).groupBy(F.col("topic").alias("event_source")).agg(F.sum(carried).alias("binary_bytes"))
    sizes = events.join(messages, "event_source")
    saved = F.lit(100.0) * (F.col("json_bytes") - F.col("binary_bytes")).cast("double") / F.col("json_bytes").cast("double")
    return sizes.withColumn("saved_percent", saved)


# ---- payloads and scalars ------------------------------------------------------------

_K_SQL = "SELECT event_id, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events"


@query("json_extract_props", _K_SQL)
def json_extract_props(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", casts.safe_cast(F.get_json_object("props", "$.k"), "int").alias("k"))


@query("payload_infer_parse", _K_SQL)
def payload_infer_parse(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", F.col("props").alias("json_payload"))
    return decode.parse_inferred(rows).select("event_id", F.col("payload.k").cast("int").alias("k"))


@query(
    "safe_casts",
    """
WITH texts AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'abc' WHEN o_orderkey % 13 = 0 THEN NULL
                          ELSE cast(o_orderkey AS varchar) END AS number_text,
         CASE WHEN o_orderkey % 17 = 0 THEN '1758872027178'
              ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS time_text FROM orders)
SELECT o_orderkey, try_cast(number_text AS integer) AS as_int, try_cast(number_text AS bigint) AS as_long,
       try_cast(number_text AS double) AS as_double,
       cast(try_cast(number_text AS decimal(10,2)) AS double) AS as_decimal,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE strftime(cast(time_text AS timestamp), '%Y-%m-%d %H:%M:%S.%f') END AS as_time
FROM texts
""",
)
def safe_casts(spark, sf_dir):
    key = F.col("o_orderkey")
    number = F.when(key % 11 == 0, "abc").when(key % 13 == 0, F.lit(None)).otherwise(key.cast("string"))
    time = F.when(key % 17 == 0, "1758872027178").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", number.alias("n"), time.alias("t"))
    n = F.col("n")
    return texts.select(
        "o_orderkey",
        casts.safe_cast(n, "int").alias("as_int"),
        casts.safe_cast(n, "bigint").alias("as_long"),
        casts.safe_cast(n, "double").alias("as_double"),
        casts.safe_cast(n, "decimal(10,2)").cast("double").alias("as_decimal"),
        casts.stamp(casts.iso_timestamp(F.col("t"))).alias("as_time"),
    )


@query(
    "rows_to_json_messages",
    """
SELECT 'orders' AS topic, cast(o_orderkey AS varchar) AS key,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS sent_at, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders
""",
)
def rows_to_json_messages(spark, sf_dir):
    messages = topics.rows_to_messages(table(spark, sf_dir, "orders"), "orders", "o_orderdate", "o_orderkey")
    shape = "timestamp string, message struct<o_custkey: bigint, o_orderstatus: string, o_totalprice: double, o_orderpriority: string>"
    parsed = messages.withColumn("m", F.from_json("value", shape))
    return parsed.select("topic", "key", F.col("m.timestamp").alias("sent_at"), "m.message.*")


@query(
    "unix_ms_to_ts",
    """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f') AS from_ms
FROM events
""",
)
def unix_ms_to_ts(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", casts.to_epoch_millis(F.col("ts")).alias("ts_ms"))
    return rows.withColumn("from_ms", casts.stamp(casts.epoch_millis(F.col("ts_ms"))))


@query(
    "event_date_fallback",
    """
SELECT event_id, strftime(CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y-%m-%d') AS event_date
FROM events
""",
)
def event_date_fallback(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("event_ts"),
        F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("ingest_ts"),
    )
    chosen = casts.event_time_or_ingest_time(F.col("event_ts"), F.col("ingest_ts"))
    return rows.select("event_id", F.to_date(chosen).cast("string").alias("event_date"))


@query(
    "date_key_lookup",
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
       dayname(o_orderdate) AS day_name, count(*) AS orders
FROM orders GROUP BY ALL
""",
)
def date_key_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    bounds = orders.agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    dates = calendar_of(bounds)
    keyed = facts.with_date_key(orders.withColumn("order_date", F.to_date("o_orderdate")), dates, "order_date")
    counted = keyed.groupBy("date_sk").agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(F.broadcast(dates), "date_sk").select(
        F.col("date_key").cast("string").alias("order_date"), "year", "quarter", "day_name", "orders"
    )


def _with_ingest_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ingest_ts", F.timestamp_add("SECOND", F.col("event_id") % 1800, F.col("ts")))


@query(
    "ingest_lag",
    """
SELECT event_type, count(*) AS rows, min(event_id % 1800) AS min_lag_s,
       quantile_cont(cast(event_id % 1800 AS double), 0.5) AS median_lag_s,
       quantile_cont(cast(event_id % 1800 AS double), 0.95) AS p95_lag_s, max(event_id % 1800) AS max_lag_s
FROM events GROUP BY 1
""",
)
def ingest_lag(spark, sf_dir):
    return stateful.ingest_lag(_with_ingest_time(_events(spark, sf_dir)), "ts", "ingest_ts", ["event_type"])


@query(
    "late_event_report",
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, count(*) FILTER (event_id % 1800 > 1500) AS late_rows
FROM events GROUP BY 1
""",
)
def late_event_report(spark, sf_dir):
    rows = _with_ingest_time(_events(spark, sf_dir))
    late = stateful.is_late(F.col("ts"), F.col("ingest_ts"))
    return rows.groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late_rows")
    )
