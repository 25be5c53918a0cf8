"""The bundle of input tables that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockaudit.schemas import TABLE_NAMES


class Tables:
    """The tables by attribute: ``Tables(orders=df, …).orders``; only those an operator reads must be given."""

    def __init__(self, base=None, **frames: DataFrame):
        unknown = set(frames) - set(TABLE_NAMES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self._base, self._frames = base, frames

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._frames:
            return self._frames[name]
        if self._base is None:
            raise AttributeError(f"table {name} was not given")
        return getattr(self._base, name)


def replace(base, **frames: DataFrame) -> Tables:
    """``base`` with some tables exchanged."""
    return Tables(base, **frames)
