"""Registered queries over the given tables."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("policies", "joins", "aggregates", "columns", "contacts", "claims", "reports", "storage", "streams")


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"millrace.catalog.{family}")
