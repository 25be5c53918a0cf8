"""The pipeline's rows and each stage's decisions against brute force."""

from __future__ import annotations

import hashlib

import public_tokenizers
from test_decontaminate import plain as contaminated
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from stockaudit.llm import language, secrets

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(spark, documents, items):
    """Rows after every stage, by doc_id."""
    frame = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.train(frame.where(~language.held_out(frame["doc_id"])))
    first = [d for d in documents if model.predict(d[1])[1] >= language.MIN_SCORE]
    prints = {d[0]: plain_fingerprint(d[1]) for d in first}
    roots = plain_components(prints.values())
    least: dict = {}
    for d in sorted(prints):
        least.setdefault(roots[prints[d]], d)
    second = [d for d in first if d[0] in set(least.values())]
    hit = {r[0] for r in contaminated([(d[0], d[1]) for d in second], items) if r[5]}
    third = [d for d in second if d[0] not in hit]
    fourth = []
    for d in third:
        text = list(d[1])
        for a, _, z in secrets.scan(d[1])[1]:
            text[a:z] = "*" * (z - a)
        fourth.append((d[0], "".join(text), *d[2:]))
    return first, second, third, fourth


def test_stages_and_rows(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    documents = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    want = expected(spark, documents, items)
    sizes = [len(documents)]
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert sorted(tuple(r) for r in out.collect()) == sorted(rows), name
        docs = corpus_pipeline.stored(out, "test")
        sizes.append(len(rows))
    assert sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[1] > 0.98 * sizes[0]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    coded = [(d[0], LIBRARY.encode(d[1], add_special_tokens=False).ids, d[1]) for d in want[-1]]
    assert got == sorted((i, len(ids), sha(",".join(map(str, ids))), sha(t)) for i, ids, t in coded)


def test_odd_rows(spark):
    """Nulls, repeats and columns named like those of the operators pass through all stages."""
    rows = [(1, "a plain text of some words here", "en", "s", 5, "x"), (1, "a plain text of some words here", "en", "s", 5, "y"),
            (2, None, None, None, None, None), (None, "another text without an id at all", None, "s", 1, "z"),
            (3, "", "en", "s", 0, ""), (4, 'its token = "abcdefgh12345678" stays', "en", "s", 3, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hits string")
    docs = docs.withColumnRenamed("hits", "fp")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"], name
    kept = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert kept == {(1, rows[0][1]), (None, rows[3][1]), (4, 'its ' + "*" * 25 + '" stays')}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 3


def test_empty_table(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
