"""Registered queries of this folder, with SQL oracles where SQL can say the same."""
from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FAMILIES = ("text_queries", "web_queries", "training_queries", "mixture_queries")


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return keep


def load() -> None:
    for family in FAMILIES:
        import_module(f"touchline.llm.{family}")
