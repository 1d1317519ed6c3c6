"""All queries of the core with their oracle SQL."""

from __future__ import annotations

from lumbung.plans import governance, marts, problems, relational, textual, warehouse

MODULES = [problems, relational, marts, governance, textual, warehouse]

QUERIES = {name: problems.prepared(f) for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
