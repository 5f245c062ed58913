"""All registered queries, by area."""

import importlib
import pkgutil

from tessera.catalog.registry import QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["QUERIES"]
