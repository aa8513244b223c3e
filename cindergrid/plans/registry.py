"""All queries of the library's own operators, by name, with their SQL."""

from __future__ import annotations

from . import bookkeeping, danger, feeds, fields, operations, runs, seasonal, verification, weather

PARTS = (danger, verification, weather, bookkeeping, feeds, seasonal, operations, fields, runs)
QUERIES = {k: f for part in PARTS for k, f in part.QUERIES.items()}
ORACLES = {k: sql for part in PARTS for k, sql in part.ORACLES.items()}
