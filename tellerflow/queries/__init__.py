"""Every operator registered by name, each beside the SQL that checks it."""

from __future__ import annotations

import importlib
import pkgutil


def load() -> tuple[dict, dict]:
    """Import all query modules and return (queries, oracle SQL)."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    from tellerflow.queries.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
