"""Registered queries of this subpackage."""

from __future__ import annotations

import importlib

MODULES = ["p1_lines", "p2_body", "p3_sentences", "p4_copies", "p5_align", "p6_quality", "p7_encode", "p8_leaks", "p9_subjects"]


def load() -> tuple[dict, dict]:
    queries, sql = {}, {}
    for name in MODULES:
        m = importlib.import_module(f"corploom.llm.{name}")
        queries |= m.QUERIES
        sql |= m.SQL
    return queries, sql
