"""Named queries over the given tables, each with an independent SQL statement where one exists."""

from __future__ import annotations

import importlib

_MODULES = ("views", "reports", "functions", "star", "weekly", "quality", "ingest", "delivery")


def load_all():
    """(queries, SQL) of all modules."""
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
    from .registry import ORACLES, RUNS

    return dict(RUNS), dict(ORACLES)
