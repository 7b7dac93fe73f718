"""Registered queries: one per operator, over the driver tables, with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

MODULES = ("views", "window_queries", "bitemporal_queries", "quality_queries", "fundamental_queries", "cross_section_queries", "rule_queries", "claim_queries", "money_queries", "monitoring_queries", "file_queries")


def load():
    from catalog import registry

    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return registry.QUERIES, registry.oracle()
