"""Operator 12 against plain Python, its index over several loads and sessions, and its plans."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stockaudit.llm import exact_dedup
from stockaudit.session import new_folder

SCHEMA = "doc_id long, text string, digest string, `Row` int, load string, n int"


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[normal(t)].append(d)
    known = lambda ids: max((d for d in ids if d is not None), default=None)
    return sorted(((d, known(groups[normal(t)]), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
                   for d, t in docs), key=str)


def frame(spark, docs, parts=5):
    return spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], SCHEMA).repartition(parts)


def run(spark, docs, **options):
    found = exact_dedup.exact_duplicates(frame(spark, docs), **options).collect()
    # one row of each group stays, the one with the group's id
    kept = [r for r in found if r["kept"]]
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len({bytes(r["digest"]) for r in kept}) == len(kept) == len({bytes(r["digest"]) for r in found})
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["digest"]).hex()) for r in found), key=str)


def shop(n=400, seed=2):
    rng = random.Random(seed)
    words = "One one ONE two Two Éa éa ÉA ß SS İ".split()
    docs = [(i, rng.choice([None, "", "A hot text", "a HOT text", "a hot text"]) if rng.random() < 0.4
             else " ".join(rng.choices(words, k=rng.randint(1, 3)))) for i in range(n)]
    return [*docs, (n, "x" * 300_000), (n + 1, "X" * 300_000)]


@pytest.mark.parametrize("options", [{}, {"loads": 1}, {"loads": 5, "rows_per_bucket": 50}])
def test_equal_to_plain_python(spark, options):
    docs = shop()
    assert run(spark, docs, **options) == plain(docs)


def test_repeated_and_null_ids(spark):
    docs = [(7, "a"), (7, "a"), (7, "A"), (None, "a"), (None, "b"), (None, "b"), (-3, "c"), (-9, "C"), (2**40, "c")]
    assert run(spark, docs, loads=3) == plain(docs)


def test_hot_groups_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT", 10)
    docs = shop()
    assert run(spark, docs) == plain(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_an_index_outlives_its_session(spark):
    folder = new_folder(spark, "index")
    first = exact_dedup.open_index(spark, folder, 4)
    got = exact_dedup.deduplicate(first, frame(spark, [(1, "a"), (5, "A"), (2, "b")]), "monday").collect()
    assert sorted(tuple(r) for r in got) == [(1, 5, False), (2, 2, True), (5, 5, True)]
    again = exact_dedup.open_index(spark.newSession(), folder, 4)
    got = exact_dedup.deduplicate(again, frame(again.spark, [(9, "B"), (8, "c"), (3, "c")]), "tuesday").collect()
    assert sorted(tuple(r) for r in got) == [(3, 8, False), (8, 8, True), (9, 2, False)]
    assert sorted((r["keep_id"], r["load"]) for r in again.entries().collect()) == [(2, "monday"), (5, "monday"), (8, "tuesday")]
    # A load that is run again adds nothing.
    exact_dedup.deduplicate(again, frame(again.spark, [(9, "B"), (8, "c"), (3, "c")]), "tuesday").collect()
    assert again.entries().count() == 3


def test_the_index_is_not_shuffled(spark):
    index = exact_dedup.open_index(spark, buckets=3)
    new = exact_dedup.stored(exact_dedup.reduced(exact_dedup.digested(frame(spark, shop()))), "reduced")
    exact_dedup.append(index, new, "0")
    plan = exact_dedup.unknown(index, new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(digest" in plan
    join = plan[plan.index("SortMergeJoin"):]
    assert "LeftAnti" in join.splitlines()[0] and "Bucketed: true" in join and "SelectedBucketsCount: 3 out of 3" in join


def test_compaction_keeps_the_entries(spark):
    index = exact_dedup.open_index(spark, buckets=4)
    for load in range(3):
        exact_dedup.deduplicate(index, frame(spark, shop(50, load)), str(load)).collect()
    small = exact_dedup.compacted(index, buckets=2)
    assert sorted(map(str, small.entries().collect())) == sorted(map(str, index.entries().collect()))
    assert len(small.entries().inputFiles()) <= 2 < len(index.entries().inputFiles())


def test_a_change_of_cores_between_the_reads(spark, monkeypatch):
    docs = shop(900)
    before = exact_dedup.append
    sizes = iter(["3", "11", "5", "7"])

    def append(*args):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", next(sizes))
        before(*args)

    monkeypatch.setattr(exact_dedup, "append", append)
    try:
        assert run(spark, docs) == plain(docs)
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_only_native_plans(spark):
    found = exact_dedup.exact_duplicates(frame(spark, shop(50)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert found.select(F.count("*")).first()[0] == 52
