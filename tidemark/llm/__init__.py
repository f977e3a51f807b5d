"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing outside this folder imports it; ``queries.py`` holds the registered queries.
"""
