"""All queries over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from muniment.plans import derive_queries, history_queries, migration_queries, record_queries, source_queries

_MODULES = (history_queries, record_queries, derive_queries, source_queries, migration_queries)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
