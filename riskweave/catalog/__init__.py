"""Named queries over the given tables, each with equivalent SQL where SQL can express it."""

from riskweave.catalog.registry import load_all, oracle_sql, queries

__all__ = ["load_all", "oracle_sql", "queries"]
