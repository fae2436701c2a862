"""Comma-separated lists and code-to-name maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_items(text: Column) -> Column:
    """Items without surrounding white space, blanks dropped, order and duplicates kept."""
    trimmed = F.transform(F.split(text, ","), lambda i: F.regexp_replace(i, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda item: item != "")


def csv_text(items: Column) -> Column:
    return F.concat_ws(",", items)


def last_wins(entries: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """One row per key with the value that comes last in ``order``.

    ``max_by`` combines on the map side, so a key that holds most rows stays cheap.
    """
    latest = F.max_by(value, F.struct(*order)).alias(value)
    return entries.groupBy(key).agg(latest)
