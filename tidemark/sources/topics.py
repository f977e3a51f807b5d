"""Topics as streams or bounded tables, from a broker or from files of topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import TOPIC_RECORD
from tidemark.session import has_source


def _topic_list(topics: str | Sequence[str]) -> str:
    names = topics.split(",") if isinstance(topics, str) else topics
    return ",".join(n.strip() for n in names if n.strip())


def _need_kafka(spark: SparkSession) -> None:
    if not has_source(spark, "kafka"):
        raise RuntimeError("reading a broker needs the spark-sql-kafka package on the class path")


def broker_options(
    topics: str | Sequence[str],
    bootstrap: str,
    starting_offsets: str = "latest",
    records_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": _topic_list(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return options


def stream_broker(spark: SparkSession, topics: str | Sequence[str], bootstrap: str, **options) -> DataFrame:
    """Unbounded read of one or more topics."""
    _need_kafka(spark)
    return spark.readStream.format("kafka").options(**broker_options(topics, bootstrap, **options)).load()


def read_broker(spark: SparkSession, topics: str | Sequence[str], bootstrap: str) -> DataFrame:
    """Everything the topics hold now, as a table."""
    _need_kafka(spark)
    options = broker_options(topics, bootstrap, "earliest")
    return spark.read.format("kafka").options(**options, endingOffsets="latest").load()


def stream_files(
    spark: SparkSession,
    path: str,
    topics: str | Sequence[str] | None = None,
    *,
    schema=TOPIC_RECORD,
    files_per_trigger: int | None = None,
    file_glob: str | None = None,
) -> DataFrame:
    """Unbounded read of Parquet files; with ``topics`` only those topics of topic records."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    records = reader.parquet(path)
    if topics is not None:
        records = records.filter(F.col("topic").isin(*_topic_list(topics).split(",")))
    return records


def message_count(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def rows_to_messages(df: DataFrame, topic: str, at: str, key: str | None = None) -> DataFrame:
    """Rows as JSON messages ``{"timestamp": ..., "message": {...}}`` ready for a broker sink.

    Dates and timestamps become ISO text, decimals plain text, binary hex digits.
    """
    fields = [_json_ready(df, c) for c in df.columns]
    message = F.to_json(
        F.struct(
            F.date_format(F.col(at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.struct(*fields).alias("message"),
        ),
        {"ignoreNullFields": "false"},
    )
    message_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), message_key.alias("key"), message.alias("value"))


def _json_ready(df: DataFrame, name: str):
    kind = df.schema[name].dataType.typeName()
    column = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif kind in ("date", "decimal"):
        column = column.cast("string")
    elif kind == "binary":
        column = F.lower(F.hex(column))
    return column.alias(name)


def write_messages(messages: DataFrame, bootstrap: str) -> None:
    """Publish messages; each executor sends its own partitions."""
    _need_kafka(messages.sparkSession)
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()
