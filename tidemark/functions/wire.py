"""Framed message values: magic byte 0x00, 4-byte big-endian schema id, body."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEADER_BYTES = 5


def is_framed(value: Column) -> Column:
    return (F.octet_length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(b"\x00"))


def schema_id(value: Column) -> Column:
    """Schema id of a framed value; NULL for unframed values and ids beyond an int."""
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10)
    return F.when(is_framed(value), number.try_cast("int"))


def payload_size(value: Column) -> Column:
    """Bytes after the header, never negative; NULL for a NULL value."""
    return F.when(value.isNotNull(), F.greatest(F.octet_length(value) - F.lit(HEADER_BYTES), F.lit(0)))


def body(value: Column) -> Column:
    """Bytes after the header of a framed value."""
    return F.when(is_framed(value), value.substr(F.lit(HEADER_BYTES + 1), F.octet_length(value)))


def hex_preview(value: Column, size: int = 20) -> Column:
    return F.hex(F.substring(value, 1, size))


def frame(schema: Column, payload: Column) -> Column:
    """Put the header before a body; the inverse of the functions above."""
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema.cast("bigint")), 8, "0")))
    return F.concat(header, payload)
