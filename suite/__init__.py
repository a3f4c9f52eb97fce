"""Registered queries: each pairs a Spark query over the given tables with the same in SQL."""

from __future__ import annotations

import importlib

MODULES = ("books", "state", "joins", "quality", "models", "causals", "wide", "edges")


def _load():
    for name in MODULES:
        importlib.import_module(f"suite.{name}")
    return importlib.import_module("suite.registry")


def all_queries() -> dict:
    """Every query by name."""
    return dict(_load().QUERIES)


def all_oracles() -> dict[str, str]:
    """SQL by query name."""
    return dict(_load().ORACLES)
