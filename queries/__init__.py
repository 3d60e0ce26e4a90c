"""Registered queries: each key with its Spark function and the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

from queries.registry import ORACLES, QUERIES

for _module in (
    "sources",
    "extraction",
    "filters",
    "joins",
    "aggregates",
    "ranks",
    "scalars",
    "jobs",
    "tables",
    "streams",
):
    import_module(f"queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
