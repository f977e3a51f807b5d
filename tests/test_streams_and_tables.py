"""Streams equal batches; storage operators keep rows."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas, workspace
from tidemark.functions import wire
from tidemark.operators import decode, upkeep
from tidemark.operators.decode import to_bronze
from tidemark.sources import jdbc, tables, topics
from tidemark.streaming import ingest, stateful


def records(spark, first, last):
    ids = spark.range(first, last)
    value = wire.frame(F.lit(17), F.encode(F.concat(F.lit('{"k": '), F.col("id").cast("string"), F.lit("}")), "UTF-8"))
    return ids.select(
        F.when(F.col("id") % 2 == 0, "orders.v1").otherwise("payments.v1").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_seconds(F.col("id") * 60 + 1704067200).alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
    )


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "topic")
    for first in (0, 100, 200):
        records(spark, first, first + 100).coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_equals_batch_and_resumes(spark, source, tmp_path):
    target, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        stream = topics.stream_files(spark, source, "orders.v1, payments.v1", files_per_trigger=1)
        return ingest.ingest_available(stream.withWatermark("timestamp", "1 minute"), target, checkpoint)

    assert not ingest.replay_is_ignored(spark, checkpoint, "earliest")
    first = run()
    progress = ingest.progress_rows(first)
    assert progress.filter("input_rows > 0").count() == 3  # one file per batch
    expected = to_bronze(spark.read.parquet(source))
    stored = ingest.read_bronze(spark, target)
    assert stored.schema == schemas.BRONZE
    assert stored.exceptAll(expected).count() == 0 and stored.count() == 300
    run()
    assert ingest.read_bronze(spark, target).count() == 300  # nothing new, nothing doubled
    records(spark, 300, 350).coalesce(1).write.mode("append").parquet(source)
    run()
    assert ingest.read_bronze(spark, target).count() == 350
    assert ingest.replay_is_ignored(spark, checkpoint, "earliest")
    assert not ingest.replay_is_ignored(spark, checkpoint, "latest")


def test_topic_filter_of_a_stream(spark, source, tmp_path):
    stream = topics.stream_files(spark, source, ["payments.v1"])
    ingest.ingest_available(stream, str(tmp_path / "b"), str(tmp_path / "c"))
    assert [r.event_source for r in ingest.read_bronze(spark, str(tmp_path / "b")).select("event_source").distinct().collect()] == ["payments.v1"]


def test_interval_stream_memory_sink_and_stop(spark, source, tmp_path):
    spark.streams.addListener(listener := ingest.ProgressLog())
    query = ingest.start_append(to_bronze(topics.stream_files(spark, source)), str(tmp_path / "b"), str(tmp_path / "c"), every="1 second", name="steady")
    peek = topics.stream_files(spark, source).select("offset").writeStream.format("memory").queryName("peek").outputMode("append").start()
    peek.processAllAvailable()
    query.processAllAvailable()
    assert spark.sql("select count(*) from peek").first()[0] == 300
    assert ingest.stop_all(spark) == 2
    assert ingest.read_bronze(spark, str(tmp_path / "b")).count() == 300
    spark.streams.removeListener(listener)


def test_dedup_across_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    start = datetime(2024, 1, 1)
    batches = [
        [(1, start), (2, start + timedelta(minutes=1)), (1, start)],
        [(2, start + timedelta(minutes=1)), (3, start + timedelta(minutes=5))],
    ]
    for batch in batches:
        spark.createDataFrame(batch, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    stream = spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    once = stateful.deduplicate(stream, ["id"], "ts").withColumn("p", F.lit(1))
    ingest.start_append(once, str(tmp_path / "out"), str(tmp_path / "c"), partition_by=("p",)).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_appending_once_loses_no_late_row(spark, tmp_path):
    path = str(tmp_path / "in")
    newest = datetime(2024, 3, 1)
    for day in (0, -9, 4, -30, 2, -3):  # files in mixed order, each with rows of another
        rows = [(abs(day) * 100 + i, newest + timedelta(days=day)) for i in range(10)] + [(0, newest)]
        spark.createDataFrame(rows, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    stream = spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    for _ in range(2):
        stateful.start_append_once(stream, str(tmp_path / "out"), str(tmp_path / "c"), ["id"]).awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted({r.id for r in spark.read.parquet(path).collect()})


def test_stored_update_and_delete_rewrite_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("a", 1, 1.0), ("a", 2, None), ("b", 3, 3.0), ("c", 4, 4.0), (None, 5, 5.0)]
    stored = tables.write_snapshot(spark.createDataFrame(rows, "k string, id int, v double"), path, ["k"])

    def files(key):
        return sorted(p.name for p in (tmp_path / "table" / f"k={key}").glob("*.parquet"))

    untouched = files("b")
    assert upkeep.update_stored(stored, path, ["k"], F.col("v") < 2, {"v": F.lit(9.0)}) == 1
    assert files("b") == untouched
    stored = spark.read.schema(stored.schema).parquet(path)
    assert upkeep.delete_stored(stored, path, ["k"], (F.col("k") == "c") | F.col("k").isNull()) == 2
    left = spark.read.schema(stored.schema).parquet(path).collect()
    assert sorted((r.id, r.v) for r in left) == [(1, 9.0), (2, None), (3, 3.0)]
    assert upkeep.delete_stored(stored, path, ["k"], F.lit(False)) == 0


def test_retention_keeps_rows_without_time(spark):
    rows = [("a", None, 1), ("a", datetime(2020, 1, 1), 2), ("a", datetime(2024, 1, 5), 3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int")
    kept = upkeep.retain_recent(df, ["k"], ["ts", "id"], F.lit("2024-01-02").cast("timestamp"))
    assert sorted(r.id for r in kept.collect()) == [1, 3]


def test_payloads_keep_odd_names_and_valid_bodies(spark):
    bodies = ['{"VOIDED":1,"OBJECT<x":{"VOID":null}}', '{"a":1,"a":2}', "nonsense"]
    df = spark.createDataFrame([(b,) for b in bodies], "json_payload string")
    parsed = decode.parse_inferred(df).collect()
    assert parsed[0].payload["VOIDED"] == 1
    framed = df.select(F.concat(F.lit(b"\x00\x00\x00\x00\x07"), F.encode("json_payload", "UTF-8")).alias("value"))
    assert [r.decode_status for r in decode.decode_frames(framed).collect()] == ["decoded", "decoded", "bad_body"]
    bad = spark.createDataFrame([("no json",)], "json_payload string")
    assert decode.parse_inferred(bad).count() == 1


def test_partial_counts_include_late_rows_and_are_repeatable(spark, tmp_path):
    path = str(tmp_path / "in")
    start = datetime(2024, 1, 10)
    for batch in [[("a", start), ("a", start)], [("a", start - timedelta(days=5)), ("b", start)]]:
        spark.createDataFrame(batch, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    for _ in range(2):
        stateful.start_partial_counts(stream, "ts", ["k"], str(tmp_path / "parts"), str(tmp_path / "c")).awaitTermination()
    got = stateful.merged_counts(spark, str(tmp_path / "parts"), ["k"])
    expected = stateful.tumbling_counts(spark.read.parquet(path), "ts", ["k"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_compaction_keeps_rows_and_splits_a_large_source(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 < 2, "big").otherwise("small").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    rows.repartition(32).write.partitionBy("source").parquet(before)
    compacted = upkeep.compact(spark, before, after, ["source"], target_bytes=400_000)
    assert compacted.exceptAll(spark.read.parquet(before)).count() == 0 and compacted.count() == 20_000
    files = {r.folder.split("=")[-1]: r.files for r in upkeep.file_statistics(spark, after).collect()}
    assert 1 < files["big"] < 32 and files["small"] < 32


def test_retention_keeps_at_least_the_newest(spark):
    rows = [("a", datetime(2024, 1, d), d) for d in (1, 2, 3)] + [("b", datetime(2023, 1, d), d) for d in (1, 2)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int")
    kept = upkeep.retain_recent(df, ["k"], ["ts", "id"], F.lit("2024-01-02").cast("timestamp"))
    assert sorted((r.k, r.id) for r in kept.collect()) == [("a", 2), ("a", 3), ("b", 2)]


def test_only_new_records(spark):
    stored = spark.createDataFrame([("s", 0, 1)], "event_source string, partition int, offset long")
    incoming = spark.createDataFrame([("s", 0, 1), ("s", 0, 2), ("s", 0, 2)], "event_source string, partition int, offset long")
    assert [r.offset for r in upkeep.only_new_records(incoming, stored).collect()] == [2]


def test_catalog_tables(spark, tmp_path):
    tables.ensure_table(spark, "shop.raw_events", schemas.BRONZE, location=str(tmp_path / "raw"), properties={"purpose": "tests"})
    tables.ensure_table(spark, "shop.raw_events", schemas.BRONZE)
    assert tables.list_tables(spark, "shop") == ["raw_events"]
    to_bronze(records(spark, 0, 10)).select(*spark.table("shop.raw_events").columns).write.insertInto("shop.raw_events")
    assert tables.read_table(spark, "shop.raw_events").filter("event_source = 'orders.v1'").count() == 5
    plan = tables.read_table(spark, "shop.raw_events").filter("event_source = 'orders.v1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_source" in plan
    tables.drop_table(spark, "shop.raw_events")
    assert tables.list_tables(spark, "shop") == []
    tables.drop_schema(spark, "shop")


def test_messages_round_trip(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2, 3, 4, 5), bytearray(b"\x0a"))], "id int, at timestamp, raw binary").withColumn("d", F.lit("1.50").cast("decimal(5,2)"))
    row = topics.rows_to_messages(df, "t", "at", "id").first()
    assert row.value == '{"timestamp":"2024-01-02T03:04:05.000000","message":{"id":1,"at":"2024-01-02T03:04:05.000000","raw":"0a","d":"1.50"}}'
    assert (row.topic, row.key) == ("t", "1")


def test_connector_options():
    options = topics.broker_options(" a , b ", "host:1", "earliest", 50_000)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "50000" and options["failOnDataLoss"] == "false"
    split = jdbc.read_options("jdbc:x", "t", split_column="id", bounds=(0, 9), partitions=3)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "3")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", split_column="id")


def test_missing_avro_package_is_reported(spark):
    from tidemark.operators.decode import decode_frames
    from tidemark.session import has_source

    assert has_source(spark, "parquet") and not has_source(spark, "avro") and not has_source(spark, "kafka")
    with pytest.raises(RuntimeError, match="Avro"):
        decode_frames(records(spark, 0, 1), avro_schemas={17: '"string"'})


def test_missing_broker_package_is_reported(spark):
    with pytest.raises(RuntimeError, match="kafka"):
        topics.read_broker(spark, "t", "host:1")


class NamedFolder:
    """Stands for a session whose cluster names a shared folder, or none."""

    def __init__(self, spark, named):
        self.sparkContext = spark.sparkContext
        self.conf = self
        self.named = named

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default


def test_scratch_folder_follows_the_cluster_setting(spark):
    assert workspace.fresh_folder(NamedFolder(spark, "/shared/somewhere/"), "x").startswith("/shared/somewhere/x-")
    first, second = (workspace.fresh_folder(NamedFolder(spark, None), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
