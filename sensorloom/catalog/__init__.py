"""Every operator as a query over the given tables, with the SQL it is checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ("sources", "rows", "shapes", "domain", "joined", "summaries", "series", "scalars", "models", "tiers")


def load():
    """The registry with all queries in it."""
    for name in MODULES:
        import_module(f"sensorloom.catalog.{name}")
    return import_module("sensorloom.catalog.registry")
