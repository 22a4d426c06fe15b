"""Rows a cutoff removes from a table, and rows it leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tailtrim.functions.predicates import at_or_above, below_or_missing


def doomed(table: DataFrame, key: str, cutoff: float) -> DataFrame:
    """The rows with ``key >= cutoff``."""
    return table.filter(at_or_above(table, key, cutoff))


def survivors(table: DataFrame, key: str, cutoff: float) -> DataFrame:
    """The rows with ``key < cutoff``, and the rows without a key."""
    return table.filter(below_or_missing(table, key, cutoff))
