"""Column expressions for messy result tables: numbers, clocks, packed pieces."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: str | Column, kind: str = "double") -> Column:
    """Cast, with missing for text that is no number (``"DNF"``)."""
    return _c(value).try_cast(kind)


def first_number(value: str | Column) -> Column:
    """The first number in a text; currency signs and thousands commas are skipped."""
    found = F.regexp_extract(_c(value), r"-?[0-9][0-9,]*\.?[0-9]*", 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def digits_only(value: str | Column) -> Column:
    """Keep digits and dots (the sign is dropped), then read a number."""
    return F.regexp_replace(_c(value), r"[^0-9.]", "").try_cast("double")


def piece(value: str | Column, pattern: str, index: int) -> Column:
    """Piece ``index`` (from 0) of a delimited text; missing when out of range."""
    return F.get(F.split(_c(value), pattern), F.lit(index))


def split_into(df: DataFrame, source: str, names: Sequence[str], pattern: str, keep: bool = False) -> DataFrame:
    """Delimited text to fixed columns. Extra pieces are dropped, absent ones missing."""
    at = df.columns.index(source)
    pieces = [piece(f"`{source}`", pattern, i).alias(name) for i, name in enumerate(names)]
    before = [F.col(f"`{c}`") for c in df.columns[: at + keep]]
    after = [F.col(f"`{c}`") for c in df.columns[at + 1:]]
    return df.select(*before, *pieces, *after)


def split_at(value: str | Column, position: int) -> tuple[Column, Column]:
    """Cut a text after ``position`` characters; negative counts from the right."""
    text = _c(value)
    if position >= 0:
        return F.substring(text, 1, position), F.substr(text, F.lit(position + 1))
    cut = F.greatest(F.char_length(text) + position, F.lit(0))
    return F.substr(text, F.lit(1), cut), F.substr(text, cut + 1)


def clock_seconds(value: str | Column) -> Column:
    """``"m:s"`` or ``"h:m:s"`` to seconds; missing when a part is no number."""
    parts = F.split(F.trim(_c(value)), ":")
    return F.aggregate(
        parts, F.lit(0.0), lambda total, part: total * 60 + F.trim(part).try_cast("double")
    )


def clock_minutes(value: str | Column) -> Column:
    return clock_seconds(value) / 60


def feet_inches(value: str | Column) -> Column:
    """``5' 11"`` to inches."""
    feet = F.regexp_extract(_c(value), r"(\d+)'", 1).try_cast("int")
    inches = F.regexp_extract(_c(value), r"(\d+)\"", 1).try_cast("int")
    return feet * 12 + inches


def date_of(value: str | Column, pattern: str) -> Column:
    """Date text by pattern; missing when it does not parse."""
    return F.try_to_date(_c(value), pattern)


def replace_all(value: str | Column, pattern: str, new: str) -> Column:
    return F.regexp_replace(_c(value), pattern, new)


def mentions(value: str | Column, *needles: str, fold_case: bool = False) -> Column:
    """Any of the texts occurs; missing text stays missing, so ``when`` falls through."""
    text = F.lower(_c(value)) if fold_case else _c(value)
    found = text.contains(needles[0])
    for needle in needles[1:]:
        found = found | text.contains(needle)
    return found


def lacks(value: str | Column, *needles: str) -> Column:
    return ~mentions(value, *needles)


def canonical_list(columns: Sequence[str | Column], sep: str = "_") -> Column:
    """Sort values of several columns and join them to one order-free key."""
    values = F.filter(F.array(*[_c(c) for c in columns]), lambda v: v.isNotNull())
    return F.concat_ws(sep, F.transform(F.array_sort(values), lambda v: v.cast("string")))


def unite(df: DataFrame, name: str, columns: Sequence[str], sep: str) -> DataFrame:
    """Join columns into one text (missing shows as ``NA``) and drop them."""
    at = df.columns.index(columns[0])
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns]
    rest = [c for c in df.columns if c not in columns]
    before = [c for c in df.columns[:at] if c not in columns]
    return df.select(*before, F.concat_ws(sep, *shown).alias(name), *[c for c in rest if c not in before])


def blank_to(value: str | Column, default: str) -> Column:
    """Empty text gets a default; missing stays missing."""
    return F.when(_c(value) == "", F.lit(default)).otherwise(_c(value))


def missing_to(value: str | Column, default) -> Column:
    return F.coalesce(_c(value), F.lit(default))


def recode(value: str | Column, codes: Mapping[str, str]) -> Column:
    """Replace known codes, keep the others."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, _c(value)), _c(value))


def first_last_name(value: str | Column) -> tuple[Column, Column]:
    """First word and the rest of a person's name."""
    text = F.trim(_c(value))
    last = F.regexp_extract(text, r"^\S+\s+(.*)$", 1)
    return F.regexp_extract(text, r"^(\S+)", 1), F.when(last != "", last)
