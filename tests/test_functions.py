import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, keys, wire
from tidemark.functions.calendar import calendar_columns


def test_wire_header_of_odd_values(spark):
    rows = [
        (1, None),
        (2, b"\x00\x00\x00\x00"),
        (3, b"\x01\x00\x00\x00\x11{}"),
        (4, b"\x00\x00\x00\x00\x11"),
        (5, b'\x00\x00\x00\x00\x11{"k": 1}'),
        (6, b"\x00\xff\xff\xff\xff{}"),
    ]
    df = spark.createDataFrame(rows, "id int, v binary")
    got = {
        r.id: (r.s, r.p, r.b)
        for r in df.select(
            "id",
            wire.schema_id(F.col("v")).alias("s"),
            wire.payload_size(F.col("v")).alias("p"),
            wire.body(F.col("v")).cast("string").alias("b"),
        ).collect()
    }
    assert got[1] == (None, None, None)
    assert got[2] == (None, 0, None)
    assert got[3] == (None, 2, None)
    assert got[4] == (17, 0, "")
    assert got[5] == (17, 8, '{"k": 1}')
    assert got[6] == (None, 2, "{}")


def test_frame_is_the_inverse(spark):
    df = spark.range(1).select(wire.frame(F.lit(4711), F.encode(F.lit("abc"), "UTF-8")).alias("v"))
    row = df.select(wire.schema_id(F.col("v")), wire.body(F.col("v")).cast("string")).first()
    assert tuple(row) == (4711, "abc")


def test_times_keep_milliseconds(spark):
    df = spark.createDataFrame([("1758872027457", "2025-09-26T07:33:47.178366Z"), ("abc", "1758872027178")], "m string, t string")
    good, bad = df.select(casts.epoch_millis(F.col("m")).alias("m"), casts.iso_timestamp(F.col("t")).alias("t")).collect()
    assert good.m.microsecond == 457000 and good.t.microsecond == 178366
    assert tuple(bad) == (None, None)


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("abc",), ("12",), (None,), ("12.345",)], "v string")
    got = df.select(
        casts.safe_cast(F.col("v"), "int").alias("i"), casts.safe_cast(F.col("v"), "decimal(10,2)").cast("string").alias("d")
    ).collect()
    assert [tuple(r) for r in got] == [(None, None), (12, "12.00"), (None, None), (None, "12.35")]


def test_fingerprint_separates_null_empty_and_separator(spark):
    rows = [(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), ("n", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    prints = [r.p for r in df.select(keys.state_fingerprint(F.col("a"), F.col("b")).alias("p")).collect()]
    assert len(set(prints)) == len(rows)
    assert prints[1] == hashlib.sha256(b"v|vx").hexdigest()


def test_surrogate_key_sees_null_positions(spark):
    df = spark.createDataFrame([(None, 5), (5, None), (5, 5), (None, None)], "a int, b int")
    got = {r.k for r in df.select(keys.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()}
    assert len(got) == 4
    wide = {r.k for r in df.select(keys.wide_surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()}
    assert len(wide) == 4 and all(len(k) == 32 for k in wide)


@pytest.mark.parametrize(
    "day,flag,expected",
    [
        ("2024-12-30", "is_year_end", False),
        ("2024-12-31", "is_year_end", True),
        ("2023-12-31", "is_year_end", True),
        ("2024-04-01", "is_quarter_start", True),
        ("2024-03-31", "is_quarter_start", False),
        ("2024-02-29", "is_month_end", True),
        ("2024-02-28", "is_month_end", False),
    ],
)
def test_calendar_flags(spark, day, flag, expected):
    column = calendar_columns(F.lit(day).cast("date"))[flag]
    assert spark.range(1).select(column).first()[0] is expected


def test_ratio_of_zero_is_null(spark):
    got = spark.createDataFrame([(4, 2), (4, 0), (None, 2)], "a int, b int").select(casts.safe_ratio(F.col("a"), F.col("b")))
    assert [r[0] for r in got.collect()] == [2.0, None, None]


def test_late_event_contract(spark):
    from tidemark.streaming.stateful import split_late

    rows = [(1, datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 25)), (2, datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 25, 1))]
    on_time, late = split_late(spark.createDataFrame(rows, "id int, e timestamp, i timestamp"), "e", "i")
    assert [r.id for r in on_time.collect()] == [1] and [r.id for r in late.collect()] == [2]
