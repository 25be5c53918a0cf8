"""EXISTS / NOT EXISTS joins whose probed side is reduced to distinct keys before it is shuffled.

A key that repeats a billion times on the probed side then costs one row per map task, so neither
form is sensitive to skew there; skew on the kept side is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged(df: DataFrame) -> DataFrame:
    """``df`` as one side of a sort-merge join, for joins of two tables that grow.

    Left alone, Spark broadcasts what its files say is small, and ids that take half a byte in a compressed file take over
    thirty in the driver, which holds every table that the checks of one report broadcast at the same time.
    """
    return df.hint("merge")


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).dropna().distinct()


def with_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(_keys(other, keys), list(keys), "left_semi")


def without_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(_keys(other, keys), list(keys), "left_anti")


def not_in(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL ``column`` has no parent (a NULL reference is not a violation)."""
    known = parent.select(F.col(parent_column).alias(column)).dropna().distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
