"""Queries that run the package's operators over the given tables, with the SQL that must agree."""

from importlib import import_module

_MODULES = ("rollups", "flow", "catalogue", "order", "texts", "places", "sheets", "job")


def load():
    """The registry with every query in it."""
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
    return import_module(f"{__name__}.registry")
