"""The offset ledger against sets of offsets."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger

SCHEMA = "event_source string, partition int, offset long, body string"


def records(seed, n=400, width=300):
    r = random.Random(seed)
    return [(r.choice("ab"), r.choice([0, 1]), r.randrange(width), f"x{i}") for i in range(n)]


def brute_ranges(rows):
    found = []
    for key in sorted({(s, p) for s, p, o, _ in rows if o is not None}):
        offsets = sorted({o for s, p, o, _ in rows if (s, p) == key and o is not None})
        run = [offsets[0], offsets[0]]
        for o in offsets[1:]:
            if o > run[1] + 1:
                found.append((*key, *run))
                run = [o, o]
            run[1] = o
        found.append((*key, *run))
    return sorted(found)


@pytest.mark.parametrize("block", [ledger.BLOCK, 8])
def test_ranges_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ledger, "BLOCK", block)
    rows = records(1) + [("a", 0, -5, "n"), ("a", 0, -4, "n"), ("a", 0, None, "n"), ("b", 1, 2**40, "n")]
    ranges = ledger.ranges_of(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, ranges.collect())) == brute_ranges(rows)
    gaps = {(r.event_source, r.partition, r.after): (r.before, r.missing) for r in ledger.gaps(ranges).collect()}
    listed = brute_ranges(rows)
    expected = {x[:2] + (x[3],): (y[2], y[2] - x[3] - 1) for x, y in zip(listed, listed[1:]) if x[:2] == y[:2]}
    assert gaps == expected


def test_union_of_ranges(spark):
    rows = [("a", 0, 1, 5), ("a", 0, 2, 3), ("a", 0, 6, 7), ("a", 0, 9, 9), ("a", 1, 8, 8), ("a", 0, 1, 5)]
    ranges = spark.createDataFrame(rows, "event_source string, partition int, first long, last long")
    assert sorted(map(tuple, ledger.union_ranges(ranges).collect())) == [("a", 0, 1, 7), ("a", 0, 9, 9), ("a", 1, 8, 8)]


@pytest.mark.parametrize("strategy,rows_per_task", [("auto", None), ("interval", None), ("timeline", None), ("timeline", 25)])
def test_new_records_are_those_in_no_range(spark, strategy, rows_per_task):
    stored, incoming = records(2, 250), records(3) + [(None, 0, 5, "no source"), ("a", 0, None, "no offset")]
    ranges = ledger.ranges_of(spark.createDataFrame(stored, SCHEMA))
    fresh = ledger.not_in(spark.createDataFrame(incoming, SCHEMA), ranges, strategy=strategy, rows_per_task=rows_per_task).collect()
    seen = {r[:3] for r in stored}
    expected = {r[:3] for r in incoming if None not in r[:3]} - seen
    assert sorted(tuple(r)[:3] for r in fresh if r.body not in ("no source", "no offset")) == sorted(expected)
    assert sorted(r.body for r in fresh if r.body in ("no source", "no offset")) == ["no offset", "no source"]


def test_batches_in_any_order_and_repeated_store_each_offset_once(spark, tmp_path):
    path = str(tmp_path / "t")
    batches = [records(seed, 120, 150) for seed in range(4)]
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    for number in (2, 0, 3, 0, 1, 3):
        ledger.append_new(frames[number], number, path)
    rows = [r for b in batches for r in b]
    stored = ledger.read_rows(spark, path, frames[0].schema)
    assert sorted(tuple(r)[:3] for r in stored.collect()) == sorted({r[:3] for r in rows})
    assert sorted(map(tuple, ledger.read_ranges(spark, path, frames[0].schema).collect())) == brute_ranges(rows)


def test_a_batch_without_ranges_is_not_there(spark, tmp_path):
    """The driver ended between the rows and the ranges of a batch."""
    path, frame = str(tmp_path / "t"), spark.createDataFrame(records(5, 50), SCHEMA)
    ledger.append_new(frame.limit(10), 0, path)
    frame.write.parquet(f"{path}/rows/batch=1")
    assert ledger.read_rows(spark, path, frame.schema).count() <= 10
    ledger.append_new(frame, 1, path)
    assert ledger.read_rows(spark, path, frame.schema).count() == len({r[:3] for r in map(tuple, frame.collect())})


def test_the_ledger_reads_no_stored_row(spark, tmp_path):
    path, frame = str(tmp_path / "t"), spark.createDataFrame(records(6, 50), SCHEMA)
    ledger.append_new(frame, 0, path)
    ranges = ledger.read_ranges(spark, path, frame.schema)
    files = set(ranges.inputFiles())
    assert files and all("/ranges/" in f for f in files)
    assert ledger.not_in(frame, ranges).filter(F.col("offset").isNotNull()).count() == 0


def test_an_empty_ledger(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    assert ledger.read_ranges(spark, str(tmp_path / "t"), frame.schema).count() == 0
    ledger.append_new(frame, 0, str(tmp_path / "t"))
    assert ledger.read_rows(spark, str(tmp_path / "t"), frame.schema).count() == 0
