"""Small hand-made frames."""

import json
from datetime import datetime

from tidemark import schemas


def at(text):
    return datetime.fromisoformat(text)


def millis(text):
    return int(datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


def change(op, image, time, lsn=None, offset=0, partition=0, table="t"):
    """A bronze row with an envelope; ``time`` is ISO text in UTC."""
    payload = {
        "before": image if op == "d" else None,
        "after": None if op == "d" else image,
        "source": {"lsn": lsn, "table": table},
        "op": op,
        "ts_ms": millis(time),
    }
    return (f"demo.public.{table}", at(time), 17, 0, json.dumps(payload), partition, offset)


def event(topic, fields, time, offset=0, partition=0):
    return (topic, at(time), 17, 0, json.dumps(fields), partition, offset)


def bronze(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE)
