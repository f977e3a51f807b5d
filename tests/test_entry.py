"""The entry point stands without the training-data folder, or where it cannot be imported."""

import builtins

import __spark_entry__ as entry
from tidemark.catalog import ORACLES, QUERIES


def test_catalog_without_the_training_data_operators(monkeypatch):
    real = builtins.__import__

    def refuse(name, *args, **kwargs):
        if name.startswith("tidemark.llm"):
            raise ImportError(name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", refuse)
    assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLES
