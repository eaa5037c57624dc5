"""Merge the query and oracle tables of every plan module."""

from __future__ import annotations

import importlib

MODULES = ["basic", "panel", "match", "ensemble", "folds", "text", "neighbours", "selection", "models", "ranked", "linear", "forms", "io"]


def _load():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"tabwright.plans.{m}")
        for k, v in mod.QUERIES.items():
            assert k not in queries, f"duplicate query {k}"
            queries[k] = v
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
