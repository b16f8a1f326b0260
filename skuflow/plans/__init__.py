"""Composed pipelines, the query registry and its DuckDB oracle."""
