"""Registered queries with their reference SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["sources", "bronze", "keys", "marts", "relational", "typed", "scalars", "serving", "checks", "stream"]


def load():
    """All registered queries, by name."""
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
    from lapstack.registry.core import QUERIES

    return dict(QUERIES)
