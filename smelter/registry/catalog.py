"""All registered queries, by name."""

from __future__ import annotations

from smelter.registry import gold, ingest, ml, quality, silver

_MODULES = (gold, silver, quality, ingest, ml)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
