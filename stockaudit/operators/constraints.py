"""Declared constraints as audits: keys, NOT NULL, references, domains, decimal widths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.schemas import DECIMALS, DOMAINS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, UNIQUE_KEYS


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _repeated(df: DataFrame, table: str, key: Sequence[str], or_null: bool) -> DataFrame:
    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    bad = F.col("n") > 1
    for k in key if or_null else ():
        bad = bad | F.col(k).isNull()
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(bad).select(
        F.lit(table).alias("table_name"), text.alias("key"), "n")


def pk_duplicates(t, keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    """Primary keys that repeat or are NULL."""
    return _union([_repeated(getattr(t, table), table, [pk], True) for table, pk in keys.items()])


def unique_violations(t, keys=UNIQUE_KEYS) -> DataFrame:
    return _union([_repeated(getattr(t, table), table, key, False) for table, key in keys])


def not_null_violations(t, required: dict[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """NULLs per NOT NULL column that the table has; one pass per table."""
    found = []
    for table, names in required.items():
        df = getattr(t, table)
        names = [n for n in names if n in df.columns]
        counted = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
        found.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("column_name"), F.col(n).alias("n_nulls"))
            for n in names]))))
    return _union(found).filter(F.col("n_nulls") > 0)


def foreign_key_violations(t, keys=FOREIGN_KEYS) -> DataFrame:
    """Unknown references with the number of rows that hold them.

    Every table is read once and gives rows of one shape: its own keys, marked as known, and each of its references.
    One grouping by (parent, value), combined map-side, settles all references in one exchange; a value that very many rows
    hold is one row per task by then.
    """
    parents = sorted({parent for *_, parent in keys})
    referring = {p: [(child, column) for child, column, parent in keys if parent == p] for p in parents}
    slots = max(map(len, referring.values()))

    def entry(parent: str, column: str, slot: int):
        return F.struct(F.lit(parents.index(parent)).alias("parent"), F.col(column).cast("bigint").alias("value"), F.lit(slot).alias("slot"))

    marked = []
    for table in sorted({child for child, *_ in keys} | set(parents)):
        own = [entry(table, PRIMARY_KEYS[table], -1)] if table in parents else []
        refs = [entry(parent, column, referring[parent].index((child, column))) for child, column, parent in keys if child == table]
        marked.append(getattr(t, table).select(F.inline(F.array(*own, *refs))).filter(F.col("value").isNotNull()))
    settled = _union(marked).groupBy("parent", "value").agg(
        F.max(F.col("slot") == -1).alias("known"), *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(slots)])
    names = [(referring[p] + [("", "")] * slots)[i] for p in parents for i in range(slots)]
    place = (F.col("parent") * slots + F.col("slot")).cast("int")
    return settled.filter(~F.col("known")).select(
        "parent", "value", F.posexplode(F.array(*[f"n{i}" for i in range(slots)])).alias("slot", "n")).filter("n > 0").select(
        F.array(*[F.lit(child) for child, _ in names])[place].alias("child"),
        F.array(*[F.lit(column) for _, column in names])[place].alias("column_name"), "value", "n")


def domain_violations(t, domains=DOMAINS) -> DataFrame:
    return _union([
        getattr(t, table).filter(~F.col(column).isin(*words))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n")
        for table, column, words in domains
    ])


def decimal_overflow(t, widths=DECIMALS) -> DataFrame:
    """Values too large for their declared decimal."""
    return _union([
        getattr(t, table)
        .filter(F.col(column).isNotNull() & F.col(column).try_cast(f"decimal({p},{s})").isNull())
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.col(PRIMARY_KEYS[table]).cast("bigint").alias("key"),
                F.col(column).cast("decimal(20,2)").alias("value"))
        for table, column, p, s in widths
    ])
