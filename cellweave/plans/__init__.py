"""Registered queries, each beside its DuckDB twin."""
