"""Rows keep their identity when the number of cores changes between two reads of a table."""

from __future__ import annotations

import itertools

import pytest

from stockaudit.llm import common, simhash, sketch, suffix_dedup
from stockaudit.session import new_folder

MODULES = (sketch, simhash, suffix_dedup)


@pytest.fixture(scope="module")
def tables(spark):
    """The test documents in 24 files, so that their split depends on the cores."""
    folder = new_folder(spark, "many-files")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(24).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture
def changing_cores(spark, monkeypatch):
    """Every stored table is followed by another number of cores."""
    def start():
        sizes = itertools.cycle(["4", "12", "3", "9"])
        real = common.stored

        def stored(df, name):
            out = real(df, name)
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", next(sizes))
            return out

        for module in (common, *MODULES):
            monkeypatch.setattr(module, "stored", stored)
    yield start
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def shown(df):
    return sorted(str(r) for r in df.collect())


@pytest.mark.parametrize("run", [
    lambda s, d: sketch.op10_sketch(s, d), lambda s, d: suffix_dedup.op2_suffix_dedup(s, d),
    lambda s, d: simhash.keep_one_of_each(common.table(s, d, "documents")),
    lambda s, d: sketch.edited_likeness(common.table(s, d, "documents"))], ids=["op10", "op2", "near_dedup", "sketch"])
def test_same_rows(spark, tables, changing_cores, run):
    want = shown(run(spark, tables))
    changing_cores()
    assert shown(run(spark, tables)) == want


def test_places_are_unique(spark, tables):
    docs = common.table(spark, tables, "documents")
    assert docs.select(common.file_place()).distinct().count() == docs.count()
