"""Registered queries: operators over the star-schema tables, with SQL that gives the same rows."""

from __future__ import annotations

from meterflow.queries import accounting, derived, flow, places, registers, sources, topology, validate

MODULES = (flow, places, sources, registers, derived, validate, accounting, topology)
QUERIES = {name: run for m in MODULES for name, run in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
