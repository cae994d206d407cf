"""Registered queries (one module per build step) and their DuckDB oracle SQL."""
