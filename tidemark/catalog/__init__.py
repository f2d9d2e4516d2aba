"""The query catalogue."""

from importlib import import_module

_PARTS = ("basics", "counts", "timed", "sequences", "scalars", "streams")


def _registry():
    registry = import_module("tidemark.catalog.registry")
    for part in _PARTS:
        import_module(f"tidemark.catalog.{part}")
    return registry


def all_queries():
    return dict(_registry().QUERIES)


def all_sql():
    return dict(_registry().SQL)
