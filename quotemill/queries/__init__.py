"""The registered queries, each with the SQL that gives the same rows."""

from quotemill.queries.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "oracle_sql", "queries"]
