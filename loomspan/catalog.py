"""Registry of the engine's own queries and their SQL."""

from __future__ import annotations

import importlib

FLAGSHIP = "map_site_inventory"
MODULES = ("urls", "filters", "pages", "tallies", "ranking", "joins", "state", "text", "sites", "pipelines", "service")


def _all():
    return [importlib.import_module(f"loomspan.plans.q_{m}").Q for m in MODULES]


def queries():
    return {name: f for q in _all() for name, (f, _) in q.items()}


def oracle_sql():
    return {name: sql for q in _all() for name, (_, sql) in q.items() if sql}
