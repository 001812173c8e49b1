"""DuckDB statements the registered queries are checked against."""

from oracle.statements import oracle_sql

__all__ = ["oracle_sql"]
