"""Independent SQL (DuckDB dialect) for every registered query: the correctness oracle."""

from .duckdb_sql import oracle_queries

__all__ = ["oracle_queries"]
