"""Window counts of a stream plus corrections against counts of all rows, after every arrival."""

import random
import time
from datetime import datetime, timedelta

import pytest

from tidemark.streaming import corrections as ops
from tidemark.streaming.lifecycle import watermark_of
from tidemark.streaming.stateful import tumbling_counts

SCHEMA = "k string, ts timestamp"
START = datetime(2024, 1, 1)


def rows(seed, late):
    r = random.Random(seed)
    found = [(r.choice("ab"), START + timedelta(hours=r.random() * 24 * 8)) for _ in range(400)]
    found.sort(key=lambda x: x[1] + timedelta(days=3 if r.random() < late else 0))
    return found + [(None, START + timedelta(days=2))]


@pytest.mark.parametrize("seed,late,files", [(1, 0.1, 4), (2, 0.0, 3)])
def test_given_counts_and_corrections_sum_up(spark, tmp_path, seed, late, files):
    found, source, out = rows(seed, late), str(tmp_path / "in"), str(tmp_path / "out")
    kinds = set()
    for i in range(files):
        part = found[len(found) * i // files : len(found) * (i + 1) // files]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.01)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        queries = ops.start_window_counts(stream, "ts", ["k"], out, str(tmp_path / "c"), lateness="2 hours")
        for query in queries.values():
            query.awaitTermination()
        stored = spark.read.schema(SCHEMA).parquet(source)
        fixes = ops.corrections(spark, stored, "ts", ["k"], out, watermark_of([queries["given"]]))
        kinds |= {r.correction for r in fixes.collect()}
        given = ops.given_counts(spark, out, stored.schema, ["k"])
        got = ops.summed(given, fixes, ["k"])
        assert sorted(map(str, got.collect())) == sorted(map(str, tumbling_counts(stored, "ts", ["k"]).select(*got.columns).collect()))
    assert given.count() >= 8  # windows that the stream told
    assert kinds == ({"add", "retract"} if late else kinds) and "add" in kinds
    seen = ops.late_rows(spark, out, stored.schema, ["k"]).count()
    assert seen > 0
