"""Registry of every implemented query and its DuckDB oracle SQL."""

from __future__ import annotations

from . import evaluate, images, io, learn, profile, runs, splits

_MODULES = [splits, profile, runs, evaluate, learn, io, images]

QUERIES: dict = {}
SQL: dict = {}
for _m in _MODULES:
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
