"""Event payloads of bronze rows as typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.casts import safe_cast, with_parsed_json
from tidemark.schemas import TOPIC_DEFAULTS, TOPICS


def of_source(bronze: DataFrame, source: str) -> DataFrame:
    """Rows of one source; prunes partitions where bronze is stored by source."""
    return bronze.filter(F.col("event_source") == source)


def parse_payload(bronze: DataFrame, fields: T.StructType, column: str = "json_payload") -> DataFrame:
    """Parse once into a struct ``payload`` of text fields; bad JSON gives NULL fields."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields.fields])
    return with_parsed_json(bronze, column, text, "payload")


def topic_rows(bronze: DataFrame, topic: str) -> DataFrame:
    """Typed rows of a topic with defaults of absent fields and bronze lineage."""
    fields = TOPICS[topic]
    defaults = TOPIC_DEFAULTS.get(topic, {})
    parsed = parse_payload(of_source(bronze, topic), fields)
    columns = []
    for field in fields.fields:
        value = safe_cast(F.col("payload")[field.name], field.dataType)
        if field.name in defaults:
            absent = F.col("payload")[field.name].isNull()
            value = F.when(absent, F.lit(defaults[field.name])).otherwise(value)
        columns.append(value.alias(field.name))
    return parsed.select(
        *columns,
        "event_time",
        F.col("partition").alias("bronze_partition"),
        F.col("offset").alias("bronze_offset"),
    )
