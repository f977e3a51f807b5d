"""Jobs from the command line arguments down, without a broker."""

import pytest
from pyspark.sql import functions as F

from helpers import bronze, change
from tidemark import jobs, workspace
from tidemark.operators.changes import CHANGE_ORDER, decode_changes
from tidemark.schemas import BRONZE, CDC_TABLES
from tidemark.sources import tables
from tidemark.sources.tables import drop_schema, ensure_table, publish, write_snapshot
from tidemark.streaming import ingest
from tidemark.streaming.upserts import compact_upserts, current_rows, upsert_batch


def product(ident, price):
    return {"product_id": ident, "title": "t", "category": "c", "price_usd": price}


def test_silver_job_reads_and_publishes_catalog_tables(spark, tmp_path):
    drop_schema(spark, "bronze")
    drop_schema(spark, "silver")
    ensure_table(spark, "bronze.demo_public_products", BRONZE, location=str(tmp_path / "products"))
    rows = bronze(spark, [change("r", product("p1", 1.0), "2024-01-01T00:00:00", 1, 1, table="products")])
    rows.select(*spark.table("bronze.demo_public_products").columns).write.insertInto("bronze.demo_public_products")
    arguments = ["build-silver", "--tables", "dim_product_catalog,dim_date", "--root", str(tmp_path / "silver")]
    jobs.main(arguments, spark)
    jobs.main(arguments, spark)
    assert spark.table("silver.dim_product_catalog").count() == 1
    assert spark.table("silver.dim_date").count() == 4018
    with pytest.raises(ValueError, match="unknown tables"):
        jobs.main(["build-silver", "--tables", "x", "--root", str(tmp_path)], spark)


def test_ingest_arguments():
    args = jobs.parser().parse_args(["ingest-events", "--topics", "a,b", "--checkpoint", "/c"])
    assert (args.table, args.batch_size, args.starting_offsets) == ("bronze.raw_events", 50_000, "latest")
    args = jobs.parser().parse_args(["ingest-cdc", "--topic", "demo.public.users", "--table", "bronze.demo_public_users", "--checkpoint", "/c"])
    assert (args.topics, args.batch_size) == ("demo.public.users", 5_000)


def test_ingest_needs_a_decoder(spark):
    args = jobs.parser().parse_args(["ingest-events", "--topics", "a", "--checkpoint", "/c"])
    with pytest.raises(ValueError, match="no decoder"):
        jobs.body_schemas(spark, args)
    args = jobs.parser().parse_args(["ingest-events", "--topics", "a", "--checkpoint", "/c", "--avro-schemas", "reg.ids"])
    with pytest.raises(RuntimeError, match="spark-avro"):
        jobs.body_schemas(spark, args)
    args = jobs.parser().parse_args(["ingest-events", "--topics", "a", "--checkpoint", "/c", "--json-bodies"])
    assert jobs.body_schemas(spark, args) == {}


def test_compaction_and_retention_jobs_finish(spark, tmp_path):
    drop_schema(spark, "kept")
    rows = spark.range(100).selectExpr("id", "id % 2 AS k", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id AS int)) AS ts")
    rows.repartition(10).write.partitionBy("k").parquet(str(tmp_path / "t"))
    place = ["--path", str(tmp_path / "t"), "--partition-by", "k", "--table", "kept.t"]
    jobs.main(["compact", *place, "--staged-path", str(tmp_path / "c")], spark)
    assert spark.table("kept.t").count() == 100
    jobs.main(["retain", *place, "--staged-path", str(tmp_path / "r"), "--keys", "k", "--order", "ts,id", "--before", "2024-03-01"], spark)
    assert sorted(r.id for r in spark.table("kept.t").collect()) == list(range(60, 100))
    drop_schema(spark, "kept")


def test_stream_into_a_catalog_table(spark, tmp_path):
    drop_schema(spark, "lake")
    source = str(tmp_path / "in")
    rows = bronze(spark, [change("r", product(f"p{i}", 1.0), "2024-01-01T00:00:00", i, i) for i in range(5)])
    rows.write.parquet(source)
    ensure_table(spark, "lake.products", BRONZE, location=str(tmp_path / "table"))
    stream = spark.readStream.schema(BRONZE).parquet(source)
    for _ in range(2):
        ingest.start_append(stream, "lake.products", str(tmp_path / "c")).awaitTermination()
    assert spark.table("lake.products").count() == 5
    drop_schema(spark, "lake")


def test_upserts_append_compact_and_repeat_safely(spark, tmp_path):
    path = str(tmp_path / "current")

    def rows(*changes):
        return decode_changes(bronze(spark, list(changes)), CDC_TABLES["products"])

    def merge(updates, batch):
        upsert_batch(updates, batch, path, ["product_id"], CHANGE_ORDER)

    first = rows(*[change("c", product(f"p{i}", float(i)), "2024-01-01T00:00:00", i, i) for i in range(20)])
    merge(first, 0)
    second = rows(
        change("u", product("p3", 33.0), "2024-01-02T00:00:00", 30, 30),
        change("u", product("p3", 34.0), "2024-01-03T00:00:00", 31, 31),
        change("u", product("p3", 1.0), "2023-01-01T00:00:00", 1, 1),
    )
    for _ in range(2):
        merge(second, 1)
    keys = (["product_id"], CHANGE_ORDER)
    expected = {**{f"p{i}": float(i) for i in range(20)}, "p3": 34.0}

    def prices(**at):
        return {r.product_id: r.price_usd for r in current_rows(spark, path, first.schema, *keys, **at).collect()}

    assert prices() == expected
    # a batch writes what it brings
    assert spark.read.parquet(f"{path}/changes/batch=1").count() == 1
    assert prices(before=1) == {**expected, "p3": 3.0}
    compact_upserts(spark, path, first.schema, *keys, upto=1)
    assert prices() == expected
    merge(rows(change("u", product("p4", 44.0), "2024-01-04T00:00:00", 40, 40)), 2)
    assert prices() == {**expected, "p4": 44.0}
    assert prices(before=1) == {**expected, "p3": 3.0}


def test_names_change_together(spark, tmp_path, monkeypatch):
    def run(name, lows):
        return {
            t: (f"{tmp_path}/{name}/{t}", tables.write_snapshot(spark.range(low, low + 2).withColumn(f"c_{name}", F.lit(low)), f"{tmp_path}/{name}/{t}").schema)
            for t, low in lows.items()
        }

    def shown():
        return {t: sorted(r.id for r in spark.table(f"together.{t}").collect()) for t in ("a", "b")}

    drop_schema(spark, "together")
    one, two = run("one", {"a": 0, "b": 10}), run("two", {"a": 20, "b": 30})
    three, four = run("three", {"a": 40, "b": 50}), run("four", {"a": 60})
    tables.publish_together(spark, "together", one)
    assert shown() == {"a": [0, 1], "b": [10, 11]} and spark.table("together.a").columns == ["id", "c_one"]
    seen = []

    def stop(*args):
        seen.append(shown())
        raise RuntimeError("stop")

    # stopped before the switch, everything is old; stopped after it, everything is new
    with monkeypatch.context() as m:
        m.setattr(tables, "_list_runs", stop)
        with pytest.raises(RuntimeError):
            tables.publish_together(spark, "together", two)
    assert seen == [{"a": [0, 1], "b": [10, 11]}] == [shown()]
    with monkeypatch.context() as m:
        m.setattr(tables, "publish", stop)
        with pytest.raises(RuntimeError):
            tables.publish_together(spark, "together", three)
    assert shown() == {"a": [40, 41], "b": [50, 51]}
    # a name that the next call leaves out stays as the stopped one left it
    tables.publish_together(spark, "together", four)
    assert shown() == {"a": [60, 61], "b": [50, 51]}
    tables.publish_together(spark, "together", two)
    assert shown() == {"a": [20, 21], "b": [30, 31]} and spark.table("together.b").columns == ["id", "c_two"]
    drop_schema(spark, "together")


def test_external_tables_and_views_are_taken_over(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/old")
    drop_schema(spark, "taken")
    ensure_table(spark, "taken.t", spark.range(1).schema, (), location=f"{tmp_path}/old")
    new = write_snapshot(spark.range(5, 7), f"{tmp_path}/new")
    tables.publish_together(spark, "taken", {"t": (f"{tmp_path}/new", new.schema)})
    assert sorted(r.id for r in spark.table("taken.t").collect()) == [5, 6]
    assert spark.read.parquet(f"{tmp_path}/old").count() == 3
    ensure_table(spark, "taken.managed", new.schema, ())
    with pytest.raises(ValueError, match="managed"):
        tables.publish_together(spark, "taken", {"t": (f"{tmp_path}/old", new.schema), "managed": (f"{tmp_path}/new", new.schema)})
    assert sorted(r.id for r in spark.table("taken.t").collect()) == [5, 6]
    drop_schema(spark, "taken")


def test_publishing_shows_exactly_the_last_run(spark, tmp_path):
    drop_schema(spark, "shown")
    columns = "day int, n long"

    def run(number, rows, by):
        path = str(tmp_path / f"run-{number}")
        stored = write_snapshot(spark.createDataFrame(rows, columns), path, by)
        publish(spark, "shown.fact", path, stored.schema)
        return sorted(map(tuple, spark.table("shown.fact").select("day", "n").collect()))

    assert run(1, [(10, 1), (20, 2)], ["day"]) == [(10, 1), (20, 2)]
    assert run(2, [(10, 3), (30, 4)], ["day"]) == [(10, 3), (30, 4)]
    assert run(3, [(40, 5)], []) == [(40, 5)]
    assert run(4, [(50, 6)], ["day"]) == [(50, 6)]
    drop_schema(spark, "shown")


def test_shared_folder_is_required_off_one_machine(spark, tmp_path):
    class Context:
        master = "spark://host:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(Session())
    Context.folder = f"{tmp_path}/set-on-the-context/"
    assert workspace.shared_root(Session()) == f"{tmp_path}/set-on-the-context"
    assert workspace.shared_root(spark)
