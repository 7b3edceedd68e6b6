"""Registered queries: name to Spark callable and, where SQL can say it, oracle text."""
from __future__ import annotations

from importlib import import_module

FAMILIES = ("sources", "columns", "joining", "grouping", "ordering", "texts", "flows", "leagues", "describing", "testing",
            "modelling", "rating")


def load() -> None:
    for family in FAMILIES:
        import_module(f"touchline.queries.{family}")
