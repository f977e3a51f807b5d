"""Casts that turn bad text into NULL, parsing of JSON text, and time conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def with_parsed_json(df: DataFrame, text: str, schema: T.StructType, name: str) -> DataFrame:
    """Add the parsed text as a struct column, parsing each row exactly once.

    A filter on a field of a plain ``from_json`` column is pushed below the projection and
    parses the text again for every field it mentions. A generator of one row stops that.
    """
    return df.select("*", F.stack(F.lit(1), F.from_json(text, schema)).alias(name))


def safe_cast(column: Column, data_type: T.DataType | str) -> Column:
    """NULL where the text is not a value of the type, instead of an error."""
    target = data_type if isinstance(data_type, str) else data_type.simpleString()
    return column.try_cast(target)


def iso_timestamp(column: Column) -> Column:
    """ISO-8601 text to timestamp; NULL for anything else."""
    return column.try_cast("timestamp")


def epoch_millis(column: Column) -> Column:
    """Milliseconds since 1970 to timestamp, keeping the milliseconds."""
    return F.timestamp_millis(column.try_cast("bigint"))


def to_epoch_millis(column: Column) -> Column:
    return F.unix_millis(column)


def event_time_or_ingest_time(event_ts: Column, ingest_ts: Column) -> Column:
    return F.coalesce(event_ts, ingest_ts)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def stamp(column: Column) -> Column:
    """Timestamp as text with microseconds, the form reports use."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def exact_sum(column: Column, scale: int = 2) -> Column:
    """Sum of money-like doubles that does not depend on the order of rows."""
    return F.sum(column.cast(T.DecimalType(18, scale)))
