"""All queries of the engine by name, and DuckDB SQL with the same rows."""

from .plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
