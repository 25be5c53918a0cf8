"""Ordered operators equal plain windows, wherever the ranges cut the groups."""

from __future__ import annotations

import random

import pytest
from shop import at
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockaudit.operators import ordered

ORDER = ["ts", "id"]


@pytest.fixture(scope="module")
def moves(spark):
    """One key holds 90 % of the rows; bursts share a time; keys, times and ids are null now and then."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        key = 1 if rng.random() < 0.9 else rng.choice([2, 3, None])
        minute = rng.choice([0, 0, 0, rng.randint(0, 500), rng.randint(0, 3), None])
        rows.append((key, None if minute is None else at(minute), i, rng.choice([None, *range(-5, 6)])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k INT, ts TIMESTAMP_NTZ, id BIGINT, v INT").cache()


def collect(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("parts", [None, 1, 3, 40])
def test_equal_to_plain_windows(moves, parts):
    w = Window.partitionBy("k").orderBy(*ORDER)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    value = F.coalesce("v", F.lit(0)).cast("bigint")
    plain = moves.withColumn("run", F.sum(value).over(upto))
    for got, want in (
        (ordered.with_previous(moves, ["k"], ORDER, {"p": "v", "pid": "id"}, parts), moves.withColumns(
            {"p": F.lag("v").over(w), "pid": F.lag("id").over(w)})),
        (ordered.with_running_total(moves, ["k"], ORDER, value, "run", parts=parts), plain),
        (ordered.with_running_total(moves, ["k"], ORDER, value, "run", low="low", parts=parts),
         plain.withColumn("low", F.min("run").over(before))),
        (ordered.with_row_number(moves, ["k"], ORDER, "rn", parts), moves.withColumn("rn", F.row_number().over(w).cast("bigint"))),
    ):
        assert collect(got) == collect(want)


def test_two_keys(moves):
    rows = moves.withColumn("j", F.col("id") % 2)
    w = Window.partitionBy("k", "j").orderBy(*ORDER)
    got = ordered.with_row_number(rows, ["k", "j"], ORDER, "rn", 25)
    assert collect(got) == collect(rows.withColumn("rn", F.row_number().over(w).cast("bigint")))


def test_a_hot_group_is_cut(moves):
    sizes = ordered.in_segments(moves, ["k"], ORDER, 30).groupBy("k", ordered.SEGMENT).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50
    assert sizes.where(F.size(ordered.SEGMENT) == 0).count() >= 1  # small groups stay whole


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint"])
def test_segments_ascend_with_the_order(spark, kind):
    """Also over the hours at which clocks change, and for the ends of the range of numbers."""
    if kind == "bigint":
        values = [-(1 << 63), -5, 0, 3, 4, 5, (1 << 63) - 1, None]
        rows = spark.createDataFrame([(1, v, i) for i, v in enumerate(values * 20)], "k int, ts bigint, id int")
    else:
        rows = spark.range(2000).selectExpr("1 as k", f"cast(timestamp_ntz'2024-03-09 20:00:00' + make_interval(0, 0, 0, 0, 0, id % 700 * 17) as {kind}) as ts", "id")
    cut = ordered.in_segments(rows, ["k"], ["ts", "id"], 30)
    ranges = cut.groupBy(ordered.SEGMENT).agg(F.min(F.struct("ts", "id")).alias("low"), F.max(F.struct("ts", "id")).alias("high"))
    found = ranges.withColumn("before", F.lag("high").over(Window.orderBy(ordered.SEGMENT)))
    assert found.count() > 8 and found.where("before >= low").count() == 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_the_data_cross_one_exchange(moves):
    """Whole groups: no other. Cut ones: the other exchanges hold a row per segment."""
    assert exchanges(ordered.with_row_number(moves, ["k"], ORDER, "rn")) == 1
    text = ordered.with_previous(moves, ["k"], ORDER, {"p": "v"}, 30)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in text and "rangepartitioning" not in text
    assert text.index("Exchange hashpartitioning") < text.index("Union")


def test_equal_rows(spark):
    same = spark.range(100).select(F.lit(1).alias("k"), F.lit(0).alias("id"), F.lit(1).alias("v"))
    run = ordered.with_running_total(same, ["k"], ["id"], F.col("v"), "run", parts=10)
    assert sorted(r.run for r in run.collect()) == list(range(1, 101))


def test_empty(moves):
    assert ordered.with_previous(moves.limit(0), ["k"], ORDER, {"p": "v"}).collect() == []


def test_an_uncut_table_crosses_the_exchange_as_it_is(moves, monkeypatch):
    """No column is added before the exchange; groups are counted themselves only where a hash bucket has too many rows."""
    for got in (ordered.with_row_number(moves, ["k"], ORDER, "rn"), ordered.with_previous(moves, ["k"], ORDER, {"p": "v"})):
        assert "_seg" not in got._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(ordered, "HASHED", 1)  # all groups in one bucket, which has too many rows
    monkeypatch.setattr(ordered, "ROWS", 1450)  # no group has
    w = Window.partitionBy("k").orderBy(*ORDER)
    got = ordered.with_row_number(moves, ["k"], ORDER, "rn")
    assert collect(got) == collect(moves.withColumn("rn", F.row_number().over(w).cast("bigint")))
