"""Operator 5: features against a plain count, learning on invented languages, defined results."""

from __future__ import annotations

import math
import random

import numpy as np

from stockaudit.llm import language


def test_grams_do_not_depend_on_chunks(monkeypatch):
    text = "The quick brown fox é 中文 jumps" * 9
    whole = np.sort(language.grams(text))
    monkeypatch.setattr(language, "_CHUNK", 10)
    assert (np.sort(language.grams(text)) == whole).all()
    n = len(text)
    assert len(whole) == n + (n - 1) + (n - 2) and len(language.grams("")) == 0 and len(language.grams("a")) == 1


def corpus(spark, n=300):
    r = random.Random(2)
    words = {"aa": ["foo", "bar", "der"], "bb": ["zim", "qua", "der"], "cc": ["ñol", "ça", "der"]}
    rows = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join(r.choices(words[lang], k=30)), lang if i % 7 else None, "x"))
    rows += [(n, None, "aa", "x"), (n + 1, "", "bb", "x"), (n + 2, "12 34 !?", "cc", "x"), (0, rows[0][1], rows[0][2], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_learns_and_marks_unknown(spark):
    docs = corpus(spark)
    model = language.train(docs.where("doc_id % 5 != 0"))
    found = language.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "score", "lang_pred", "score_"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] < 300:
            assert r["lang_pred"] == ("aa", "bb", "cc")[r["doc_id"] % 3] and 0.5 < r["score_"] <= 1
        else:
            assert (r["lang_pred"], r["score_"]) == ("und", 0.0)
    assert (model.weights == 0).mean() > 0.9  # the L1 penalty keeps them sparse


def test_sample_bound(spark):
    model = language.train(corpus(spark), sample=60)
    assert model.languages == ["aa", "bb", "cc"]


def test_document_frequencies(spark):
    docs = corpus(spark, 40)
    got = {r["feature"]: r["n"] for r in language.document_frequencies(docs).collect()}
    want: dict = {}
    for r in docs.collect():
        for g in set(language.grams(r["text"] or "").tolist()):
            want[g] = want.get(g, 0) + 1
    assert got == want


def test_without_labels(spark):
    docs = corpus(spark, 10).withColumn("lang", language.F.lit(None).cast("string"))
    rows = language.identify(docs, language.train(docs)).collect()
    assert {(r["lang_pred"], r["score_"]) for r in rows} == {("und", 0.0)}


def test_stage_keeps_columns(spark):
    docs = corpus(spark)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(300))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = language.op5_language_id(spark, sf).join(spark.read.parquet(sf + "/documents.parquet").select("doc_id", "lang"),
                                                    "doc_id").where("held_out").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


def test_signs_are_no_letters(spark):
    model = language.fit([("the cat", "en"), ("der Hund", "de")] * 10, np.ones(1 << language.BITS))
    assert [model.predict(x)[0] for x in ("½ ² ① Ⅷ 3_4", "", None, "١٢")] == ["und"] * 4
    assert model.predict("½ a")[0] in ("en", "de") and model.predict("日")[0] in ("en", "de")


def test_ftrl_equals_a_plain_loop():
    """The same updates, coordinate by coordinate, over dictionaries."""
    rng = np.random.Generator(np.random.PCG64(1))
    examples = [(np.sort(rng.choice(50, 6, replace=False)), rng.random(6), int(rng.integers(3))) for _ in range(40)]
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.02
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    order = np.random.Generator(np.random.PCG64(5))
    for _ in range(3):
        for i in order.permutation(len(examples)):
            at, value, label = examples[i]
            w = {(f, c): weight((f, c)) for f in at.tolist() for c in range(3)}
            score = [sum(v * w[f, c] for f, v in zip(at.tolist(), value)) for c in range(3)]
            total = sum(math.exp(s) for s in score)
            for f, v in zip(at.tolist(), value):
                for c in range(3):
                    g = v * (math.exp(score[c]) / total - (c == label))
                    old = n.get((f, c), 0.0)
                    z[f, c] = z.get((f, c), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[f, c]
                    n[f, c] = old + g * g
    got = language.ftrl(examples, 3)
    assert np.allclose(got[:50], [[weight((f, c)) for c in range(3)] for f in range(50)])
    assert (got == 0).any() and not got[50:].any()
