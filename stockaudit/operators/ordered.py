"""Ordered per-group operators that stay parallel when one group holds most of the rows.

A plain window puts a whole group into one task. Here a group with too many rows is cut into segments: fixed, equally wide
buckets of its ordering column, from its lowest value to its highest. A counted pass finds buckets that still hold too
many rows; they are cut again, by the next ordering column where they hold a single value. Windows run inside (group,
segment), so that the data cross one exchange, hashed by these. The segments of a cut group are summarised map-side (sum, lowest,
last value); what the segments before carry over is one more row, ahead of the segment's own. Spark's own ordering places
NULLs, in a bucket before all others.

Rows that are equal in all ordering columns stay together, as do rows whose ordering columns are neither integers nor times.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How many parts a table is cut into if one group holds all of it; without the setting, ``ROWS`` and ``UNITS`` decide.
PARTS_SETTING = "spark.stockaudit.parts"
#: Rows that a task may well sort.
ROWS = 2_000_000
#: Bound on the groups and buckets that are cut at once, which are broadcast: each has more than this share of all rows.
UNITS = 1 << 16
#: Hash buckets whose counts bound the groups in them; groups are counted themselves only where a bucket has too many rows.
HASHED = 1 << 14
#: Buckets that a group or bucket is cut into.
CELLS = 256
SEGMENT = "_segment"
_CARRY = "_carry"


def _position(column: str, kind: T.DataType) -> Column | None:
    """A long that ascends with the column."""
    c = F.col(column)
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):  # without a time zone's jumps
        seconds = F.unix_date(F.to_date(c)).cast("bigint") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
        return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return None


def _same(df: DataFrame, side: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Column]:
    """``side`` with its names marked, and the null-safe join condition."""
    renamed = side.withColumnsRenamed({n: f"_s_{n}" for n in names})
    return renamed, reduce(lambda a, b: a & b, [df[n].eqNullSafe(renamed[f"_s_{n}"]) for n in names])


def _segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None,
               largest: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` with each row's segment, a list of bucket numbers that ascends with the order, and whether any group is cut.

    ``largest`` is a bound on the rows of a group, if the caller knows one.
    """
    parts = parts or int(df.sparkSession.conf.get(PARTS_SETTING, "0"))
    rows = df.withColumn(SEGMENT, F.array().cast("array<bigint>"))
    if largest is not None and largest <= ROWS and not parts:
        return rows, False
    sizes = lambda *group: df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    total, most = sizes(F.pmod(F.xxhash64(*keys), F.lit(HASHED)))
    limit = -(-(total or 0) // parts) if parts else max(ROWS, (total or 0) // UNITS)
    if not total or most <= limit or sizes(*keys)[1] <= limit:
        return rows, False
    unit = [*keys, SEGMENT]
    at = [p for p in (_position(c, df.schema[c].dataType) for c in order) if p is not None]
    measures = [f(p).alias(f"_{name}{i}") for i, p in enumerate(at)
                for name, f in (("low", F.min), ("high", F.max), ("known", F.count))]
    level, cut = 0, False
    while True:
        large = rows.filter(F.size(SEGMENT) == level).groupBy(*unit).agg(F.count(F.lit(1)).alias("_n"), *measures)
        units = []  # each has more rows than the limit, so there are fewer than total / limit
        for r in large.filter(F.col("_n") > limit).collect():
            for i in range(len(at)):
                low, high, known = r[f"_low{i}"], r[f"_high{i}"], r[f"_known{i}"]
                if known and (low != high or known < r["_n"]):
                    units.append((*(r[c] for c in unit), i, low, (high - low) // CELLS + 1))
                    break
        if not units:
            return rows, cut
        schema = T.StructType([*(rows.schema[c] for c in unit), *T.StructType.fromDDL(
            "_by int, _low decimal(20,0), _width decimal(20,0)").fields])
        units = [(*u[:-2], *map(Decimal, u[-2:])) for u in units]
        side, on = _same(rows, df.sparkSession.createDataFrame(units, schema), unit)
        position = reduce(lambda a, i: F.when(F.col("_by") == i, at[i]).otherwise(a), range(len(at)), F.lit(None).cast("bigint"))
        rows = rows.join(F.broadcast(side), on, "left").withColumn("_position", position.cast("decimal(20,0)"))
        cell = F.coalesce(F.expr("(_position - _low) div _width"), F.lit(-1))
        rows = rows.withColumn(SEGMENT, F.when(F.col("_by").isNull(), F.col(SEGMENT)).otherwise(
            F.concat(SEGMENT, F.array(cell)))).drop("_by", "_low", "_width", "_position", *[f"_s_{c}" for c in unit])
        level, cut = level + 1, True


def in_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """``df`` with the segment of each row: empty for groups that one task may hold."""
    return _segmented(df, keys, order, parts)[0]


def _with_carries(rows: DataFrame, carries: DataFrame) -> DataFrame:
    return rows.withColumn(_CARRY, F.lit(0)).unionByName(carries.withColumn(_CARRY, F.lit(1)), allowMissingColumns=True)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], parts: int | None = None
) -> DataFrame:
    """Add the previous row's value per group: ``columns`` maps output name to input column."""
    rows, cut = _segmented(df, keys, order, parts)
    if not cut:  # the exchange carries nothing but the rows
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({o: F.lag(c).over(w) for o, c in columns.items()})
    group, read = [*keys, SEGMENT], list(dict.fromkeys(columns.values()))
    last = rows.filter(F.size(SEGMENT) > 0).groupBy(*group).agg(F.max_by(F.struct(*read), F.struct(*order)).alias("_last"))
    last = last.withColumn("_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy(SEGMENT)))
    # A key that is also read has its own value in the rows before, so the read columns win.
    own = [c for c in group if c not in read]
    rows = _with_carries(rows, last.filter(F.col("_last").isNotNull()).select(*own, "_last.*"))
    w = Window.partitionBy(*group).orderBy(F.desc(_CARRY), *order)
    out = rows.withColumns({o: F.lag(c).over(w) for o, c in columns.items()})
    return out.filter(F.col(_CARRY) == 0).drop(_CARRY, SEGMENT)


def with_running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], low: str | None = None,
    parts: int | None = None, largest: int | None = None,
) -> DataFrame:
    """Add running sums per group: ``values`` maps output names to what is summed; ``low`` names the lowest value of the first
    sum before the row."""
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    main, given = next(iter(values)), {f"_seg_value{i}": v.cast("bigint") for i, v in enumerate(values.values())}
    rows, cut = _segmented(df, keys, order, parts, largest)
    if not cut:  # the exchange carries nothing but the rows
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumns({o: F.sum(v).over(upto(w)) for o, v in zip(values, given.values())})
        return res.withColumn(low, F.min(main).over(before(w))) if low else res
    rows, group = rows.withColumns(given), [*keys, SEGMENT]
    inside = rows.filter(F.size(SEGMENT) > 0)
    sums = [F.sum(v).alias(v) for v in given]
    if low:
        inside = inside.withColumn("_seg_run", F.sum("_seg_value0").over(upto(Window.partitionBy(*group).orderBy(*order))))
        sums.append(F.min("_seg_run").alias("_seg_min"))
    earlier = before(Window.partitionBy(*keys).orderBy(SEGMENT))
    carries = inside.groupBy(*group).agg(*sums)
    if low:
        total = F.coalesce(F.sum("_seg_value0").over(earlier), F.lit(0))
        carries = carries.withColumn("_seg_low", total + F.col("_seg_min"))
    carries = carries.withColumns({v: F.sum(v).over(earlier) for v in given} | (
        {"_seg_low": F.min("_seg_low").over(earlier)} if low else {})).drop("_seg_min")
    known = reduce(lambda a, b: a | b, (F.col(v).isNotNull() for v in given))
    rows = _with_carries(rows, carries.filter(known))
    w = Window.partitionBy(*group).orderBy(F.desc(_CARRY), *order)
    res = rows.withColumns({o: F.sum(v).over(upto(w)) for o, v in zip(values, given)})
    if low:  # all windows share one exchange and one sort
        lowest = F.when(F.col(_CARRY) == 1, F.col("_seg_low")).otherwise(F.col(main))
        res = res.withColumn(low, F.min(lowest).over(before(w)))
    return res.filter(F.col(_CARRY) == 0).drop(_CARRY, SEGMENT, "_seg_low", *given)


def with_running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    low: str | None = None, parts: int | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` per group; ``low`` names its lowest value before the row."""
    return with_running_totals(df, keys, order, {out: value}, low, parts)


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, parts: int | None = None) -> DataFrame:
    return with_running_total(df, keys, order, F.lit(1), out, parts=parts)
