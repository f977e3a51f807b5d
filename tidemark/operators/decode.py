"""Framed message values to JSON text, with a status per row and no Python per row."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import wire
from tidemark.operators.sizing import broadcast_if_small
from tidemark.session import has_source


def decode_frames(
    records: DataFrame,
    value: str = "value",
    *,
    json_schemas: DataFrame | None = None,
    avro_schemas: Mapping[int, str] | None = None,
) -> DataFrame:
    """Add ``schema_id``, ``payload_size``, ``json_payload`` and ``decode_status``.

    ``json_schemas`` is a table with a ``schema_id`` column naming the ids with JSON bodies;
    without it every framed body is taken as JSON. ``avro_schemas`` maps ids to Avro schema
    text and needs the Avro reader on the class path. Statuses: ``decoded``, ``missing``,
    ``short``, ``bad_magic``, ``unknown_schema``, ``bad_body``.
    """
    column = F.col(value)
    out = records.withColumns(
        {"schema_id": wire.schema_id(column), "payload_size": wire.payload_size(column)}
    )
    text = wire.body(column).try_cast("string")
    known: Column = F.col("schema_id").isNotNull()
    if json_schemas is not None:
        # nearly all rows share a few ids: a shuffle on the id would gather them in one task
        ids = broadcast_if_small(json_schemas.select(F.col("schema_id").alias("_known_id")).distinct())
        out = out.join(ids, F.col("schema_id") == F.col("_known_id"), "left")
        known = F.col("_known_id").isNotNull()
    parsed = F.when(known & _is_json(text), text)
    if avro_schemas:
        parsed = F.coalesce(_avro_text(records, column, avro_schemas), parsed)
        known = known | F.col("schema_id").isin(*avro_schemas)
    out = out.withColumn("json_payload", parsed)
    status = (
        F.when(column.isNull(), "missing")
        .when(F.octet_length(column) < wire.HEADER_BYTES, "short")
        .when(~wire.is_framed(column), "bad_magic")
        .when(~known, "unknown_schema")
        .when(F.col("json_payload").isNull(), "bad_body")
        .otherwise("decoded")
    )
    return out.withColumn("decode_status", status).drop("_known_id")


def _is_json(text: Column) -> Column:
    """Whether a text is one JSON value.

    The variant parser refuses some valid bodies (repeated keys, bodies beyond its size limit).
    Those count if the streaming parser reads an object or array that the text also ends with.
    """
    enclosed = F.rlike(text, F.lit(r"(?s)^\s*(\{.*\}|\[.*\])\s*$"))
    return F.try_parse_json(text).isNotNull() | (enclosed & F.get_json_object(text, "$").isNotNull())


def _avro_text(records: DataFrame, value: Column, schemas: Mapping[int, str]) -> Column:
    if not has_source(records.sparkSession, "avro"):
        raise RuntimeError("Avro bodies need the spark-avro package on the class path")
    from pyspark.sql.avro.functions import from_avro

    decoded = [
        F.when(
            wire.schema_id(value) == number,
            F.to_json(from_avro(wire.body(value), schema, {"mode": "PERMISSIVE"})),
        )
        for number, schema in sorted(schemas.items())
    ]
    return F.coalesce(*decoded)


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that decoded, and the quarantine with the raw value and the reason."""
    good = F.col("decode_status") == "decoded"
    return decoded.filter(good), decoded.filter(~good)


def to_bronze(records: DataFrame, **schemas) -> DataFrame:
    """Topic records to bronze rows (see ``schemas.BRONZE``)."""
    return decode_frames(records, **schemas).select(
        F.col("topic").alias("event_source"),
        F.col("timestamp").alias("event_time"),
        "schema_id",
        "payload_size",
        "json_payload",
        "partition",
        "offset",
    )


def infer_payload_schema(bronze: DataFrame, column: str = "json_payload") -> str:
    """DDL of the payload, merged over all rows by a distributed aggregate."""
    merged = bronze.select(F.expr(f"schema_of_variant_agg(try_parse_json({column}))")).first()[0]
    return _as_ddl(merged) if merged and merged != "VOID" else "STRUCT<>"


# a quoted name, a plain name before its colon, or a type that DDL spells differently
_NAME_OR_TYPE = re.compile(r"(`(?:[^`]|``)*`|[^\s<>,:`]+(?=\s*:))|\bOBJECT<|\bVOID\b")


def _as_ddl(variant_type: str) -> str:
    """Type of a variant as DDL; only types are respelt, never field names."""
    spelt = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    return _NAME_OR_TYPE.sub(lambda found: found[1] or spelt[found[0]], variant_type)


def parse_inferred(bronze: DataFrame, column: str = "json_payload") -> DataFrame:
    """Attach ``payload`` parsed with the inferred schema."""
    return bronze.withColumn("payload", F.from_json(column, infer_payload_schema(bronze, column)))
