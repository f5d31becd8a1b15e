"""Registered queries, their DuckDB oracles, and the end-to-end layer jobs."""
