"""All core queries by name, with their oracle SQL."""

from __future__ import annotations

from millrace.plans import curation, files, health, lookups, orphans, outcomes, samples, scoring

_MODULES = [curation, orphans, samples, lookups, scoring, health, files, outcomes]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
