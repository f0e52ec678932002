"""Registered queries: one per inventory id, each over the whole test tables."""

from __future__ import annotations

import importlib
import pkgutil

from larder.catalog import registry


def _load() -> None:
    for mod in pkgutil.iter_modules(__path__):
        if mod.name != "registry":
            importlib.import_module(f"{__name__}.{mod.name}")


def all_queries():
    _load()
    return dict(sorted(registry.QUERIES.items()))


def all_oracles():
    _load()
    return dict(sorted(registry.ORACLES.items()))
