"""Lookups over gold tables (QRY-1..7): category list and filtered reads, with the filter in the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def categories(gold: DataFrame, col: str = "Category") -> DataFrame:
    """Sorted distinct categories."""
    return gold.select(col).distinct().orderBy(col)


def lookup(gold: DataFrame, category: str | None = None, strict: bool = False, col: str = "Category") -> DataFrame:
    """Rows of a gold table, optionally for one category (exact, case-sensitive).

    ``None`` or ``""`` means no filter. With ``strict``, an unknown category raises
    ``ValueError("Invalid category: ...")`` (one ``isEmpty`` probe of the filtered plan);
    otherwise the result is simply empty.
    """
    if not category:
        return gold
    out = gold.where(F.col(col) == F.lit(category))
    if strict and out.isEmpty():
        raise ValueError(f"Invalid category: {category}")
    return out
