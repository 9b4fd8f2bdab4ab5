"""Loads every catalogue module and hands out the registered queries."""

from __future__ import annotations

import importlib

from . import catalog

MODULES = ["core_queries", "analytics_queries", "change_queries", "ingest_queries", "text_queries", "model_queries", "job_queries"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")


def queries():
    _load()
    return dict(catalog._QUERIES)


def oracle_sql():
    _load()
    return dict(catalog._ORACLES)
