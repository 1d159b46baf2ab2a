"""Registered queries, one module per operator family."""

from __future__ import annotations

import importlib

MODULES = ["layers", "cleaning", "relational", "quality", "storage", "streaming"]


def load_all():
    """Import every family and return the registry."""
    for name in MODULES:
        importlib.import_module(f"tillhouse.queries.{name}")
    from tillhouse.queries.registry import QUERIES

    return dict(QUERIES)
