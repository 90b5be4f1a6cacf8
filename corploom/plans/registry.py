"""Registered queries of the core: name -> callable(spark, sf_dir), and the equivalent SQL where there is one."""

from __future__ import annotations

import importlib

MODULES = ["cleaning", "formats", "relations", "search", "equivalents"]


def load() -> tuple[dict, dict]:
    queries, sql = {}, {}
    for name in MODULES:
        m = importlib.import_module(f"corploom.plans.{name}")
        queries |= getattr(m, "QUERIES", {})
        sql |= m.SQL
    return queries, sql
