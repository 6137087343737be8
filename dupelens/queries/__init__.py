"""Registered queries by family: each module maps names to Spark callables and to check SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("exact", "catalogs", "fuzzy", "pairs", "ingest")


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for family in FAMILIES:
        merged.update(getattr(import_module(f"dupelens.queries.{family}"), attribute))
    return merged


def spark_queries() -> dict:
    return _collect("SPARK")


def check_sql() -> dict:
    return _collect("SQL")
