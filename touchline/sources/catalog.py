"""Dataset pages: topic index and contract check."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_topics(pages: DataFrame, page: str, text: str) -> DataFrame:
    """(page, topic) from the ``categories:`` list of a page's front matter, lower-cased."""
    matter = F.regexp_extract(F.col(text), r"(?s)\A---\s*\n(.*?)\n---", 1)
    listed = F.regexp_extract(matter, r"(?m)^categories:[ \t]*\n((?:[ \t]+-[^\n]*(?:\n|\z))+)", 1)
    items = F.regexp_extract_all(listed, F.lit(r"(?m)^[ \t]+-[ \t]*(.*?)[ \t]*$"), F.lit(1))
    topics = pages.select(page, F.explode(items).alias("topic"))
    topics = topics.select(page, F.lower(F.trim(F.regexp_replace("topic", "[\"']", ""))).alias("topic"))
    return topics.where(F.col("topic") != "").distinct()


def topic_index(topics: DataFrame, page: str) -> DataFrame:
    """Pages per topic. The member list stays in long form, as one topic can hold most pages."""
    return topics.groupBy("topic").agg(
        F.count(F.lit(1)).alias("pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page")
    )


@dataclass(frozen=True)
class Contract:
    """What a table's page declares."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    rows: int | None = None


def profile(df: DataFrame, name: str, contract: Contract) -> DataFrame:
    """One row: rows, distinct keys, missing cells, and whether the contract holds."""
    present = [c for c in contract.columns if c in df.columns]
    holes = reduce(lambda a, b: a + b, [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
    facts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.struct(*contract.key)).alias("n_keys"),
        holes.alias("missing_cells"),
    )
    keys_unique = F.col("n_keys") == F.col("n_rows")
    rows_match = F.lit(None).cast("boolean") if contract.rows is None else F.col("n_rows") == contract.rows
    return facts.select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(contract.columns) - len(present)).alias("absent_columns"),
        F.lit(len([c for c in df.columns if c not in contract.columns])).alias("undeclared_columns"),
        "n_keys",
        "missing_cells",
        keys_unique.alias("key_is_unique"),
        rows_match.alias("rows_as_declared"),
    )


def check_contracts(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """One row per table with its declared and actual shape."""
    parts: Sequence[DataFrame] = [profile(tables[n], n, c) for n, c in contracts.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
