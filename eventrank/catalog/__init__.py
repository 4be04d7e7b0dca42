"""Registered queries with the SQL that states their expected result."""

from __future__ import annotations

import importlib

MODULES = ["features", "cleaning", "tracking", "weather", "storage", "evaluation", "modelling"]


def load() -> tuple[dict, dict]:
    """All queries by name, and the SQL of those whose result SQL can state."""
    for module in MODULES:
        importlib.import_module(f"eventrank.catalog.{module}")
    registry = importlib.import_module("eventrank.catalog.registry")
    return dict(registry.QUERIES), dict(registry.EXPECTED)
