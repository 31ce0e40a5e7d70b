"""All queries of the core, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from stepweave.plans import core_oracle, core_queries, curation_queries

_MODULES = [core_queries, curation_queries]
_SQL = [core_oracle, curation_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _SQL for k, v in m.oracle_sql().items()}
