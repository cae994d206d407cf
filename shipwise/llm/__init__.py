"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package; the registered queries are
in ``queries.py`` and their DuckDB statements in ``oracle.py``.
"""
