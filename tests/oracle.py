"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() else float(f"{value:.12g}")
    return repr(value)


def _sorted(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(row[i]) for i in places] for row in rows), key=repr)


def differences(df, connection, sql):
    """Empty text if equal, else a short report."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = [tuple(r) for r in df.collect()]
    a, b = _sorted(df.columns, got), _sorted(names, expected)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}; first {a[:2]} / {b[:2]}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ; first {wrong[:2]}" if wrong else ""
