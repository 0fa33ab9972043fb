"""All named queries over the reference tables, with their DuckDB counterparts."""

from __future__ import annotations

from tidemark.plans import agents, bursts, clusters, evaluations, files, live, relational, streams, texts

MODULES = (relational, texts, bursts, evaluations, clusters, streams, files, live, agents)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
