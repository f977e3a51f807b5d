"""Retail lakehouse operators as PySpark DataFrame, SQL and streaming compositions."""

__version__ = "0.1.0"
