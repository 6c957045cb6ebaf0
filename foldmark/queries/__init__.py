"""Named queries over the given tables, with their SQL oracles."""

import importlib

from .registry import ORACLES, QUERIES

MODULES = ("core", "sets", "reads", "outputs", "experiments")


def _load():
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
