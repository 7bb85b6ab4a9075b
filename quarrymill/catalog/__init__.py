"""Registered queries, each with the SQL that DuckDB runs on the same tables where SQL can say it."""

import importlib
import pkgutil

from .registry import ORACLES, QUERIES  # noqa: F401

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("q_")):
    importlib.import_module(f"{__name__}.{_module}")
