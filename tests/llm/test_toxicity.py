"""Operator 8: the shared and the class models against plain Kneser-Ney, held-out accuracy, defined results."""

from __future__ import annotations

import math
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockaudit.llm import toxicity as t

N, D = t.ORDER, t.DISCOUNT


def plain_grams(text):
    gap = " " * (N - 1)
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    whole = gap.join(["", *words, ""])
    return [whole[i:i + N] for i in range(len(whole) - N + 1) if not whole[i:i + N].endswith("  ")]


class Plain:
    def __init__(self, rows):
        self.own = {c: Counter(g for x, y in rows if y == c for g in plain_grams(x)) for c in (0, 1)}
        by = {N: self.own[0] + self.own[1]}
        for n in range(N - 1, 0, -1):
            by[n] = Counter(g[1:] for g in by[n + 1])
        self.by = by
        self.kinds = defaultdict(int)
        self.total = defaultdict(int)
        for n in range(1, N + 1):
            for g, k in by[n].items():
                self.kinds[g[:-1]] += 1
                self.total[g[:-1]] += k

    def shared(self, g):
        if len(g) == 1:
            return self.by[1][g] / self.total[""]
        h = g[:-1]
        return (self.by[len(g)][g] - D + D * self.kinds[h] * self.shared(g[1:])) / self.total[h]

    def chance(self, c, g, below):
        same = {x: k for x, k in self.own[c].items() if x[:-1] == g[:-1]}
        total, kinds = sum(same.values()), len(same)
        own = max(0.0, same.get(g, 0) - D) if g in same else 0.0
        return (own + (t.STRENGTH + D * kinds) * below) / (t.STRENGTH + total)

    def ratio(self, text):
        total, words = 0.0, 0
        word = 0.0
        for g in plain_grams(text):
            if g in self.by[N]:
                word += math.log(self.chance(1, g, self.shared(g)) / self.chance(0, g, self.shared(g)))
            elif any(x[:-1] == g[:-1] for x in self.by[N]):
                word += math.log(self.chance(1, g, 1.0) / self.chance(0, g, 1.0))
            if g.endswith(" "):
                total += math.log1p(t.TOXIC_SHARE * math.expm1(word))
                words, word = words + 1, 0.0
        return math.asinh(total / (words + t.PRIOR_WORDS) / t.TOXIC_SHARE * 4)


def corpus(n=240, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        words = r.choices(["alpha", "beta", "gamma", "delta", "ébène", "the"], k=r.randint(8, 40))
        if bad:
            words[r.randrange(len(words))] = r.choice(["nasty", "awful", "vile"])
        rows.append((i, r.choice([" ", ", "]).join(words).title(), int(bad)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, x, "s") for i, x, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_equals_plain_models(spark):
    rows = corpus(40)
    labelled = spark.createDataFrame([(x, y) for _, x, y in rows], "text string, toxic int")
    counts = t.count_grams(labelled)
    plain = Plain([(x, y) for _, x, y in rows])
    got = {r["gram"]: (r["t"], r["o"]) for r in counts.collect()}
    assert got == {g: (plain.own[1][g], plain.own[0][g]) for g in plain.by[N]}
    for r in t.shared_model(counts).collect():
        assert r["shared"] == pytest.approx(plain.shared(r["gram"]))
    model = t.Model(t.tables_of(t.ratios(counts)))
    for text in ["Alpha nasty beta", "alphabet bet", "unseen words", "", None, "a", *(x for _, x, _ in rows[:5])]:
        assert model.ratio(text) == pytest.approx(plain.ratio(text), abs=1e-4)


def test_chunks_give_the_same(spark, monkeypatch):
    model = t.train(*frames(spark, corpus()))
    text = " ".join(x for _, x, _ in corpus(60, 5))
    whole = model.ratio(text)
    monkeypatch.setattr(t, "_CHUNK", 50)
    assert model.ratio(text) == pytest.approx(whole)


def test_learns_and_defined_results(spark):
    docs, labels = frames(spark, corpus())
    labels = labels.union(labels.limit(3)).union(spark.createDataFrame([(9999, 1, 1), (5, 1, None), (None, 1, 0)], labels.schema))
    model = t.train(docs, labels)
    new = corpus(80, 9)
    odd = [(1000, None, 0), (1001, "", 0), (1002, "x", 0), (1003, "12 !!", 0), (1000, None, 0), (None, "nasty " * 30_000, 1)]
    found = t.score_toxicity(frames(spark, new + odd)[0], model)
    assert found.columns == ["doc_id", "text", "score", "score_", "predicted"]
    rows = found.collect()
    assert len(rows) == len(new) + len(odd) and all(0 <= r["score_"] <= 1 for r in rows)
    want = {i: y for i, _, y in new + odd}
    assert np.mean([r["predicted"] == want[r["doc_id"]] for r in rows]) > 0.97
    assert all(r["predicted"] == (r["score_"] >= t.THRESHOLD) for r in rows)


def test_without_a_class(spark):
    docs, labels = frames(spark, corpus(20))
    rows = t.score_toxicity(docs, t.train(docs, labels.where("toxic = 0"))).collect()
    assert len(rows) == 20 and {r["score_"] for r in rows} == {0.0}
    empty = docs.limit(0)
    assert t.score_toxicity(empty, t.train(empty, labels)).collect() == []


def test_held_out_accuracy(spark):
    """The labels of this size are few; those that the model finds must be right."""
    sf = "/root/testdata/sf0.1"
    rows = t.op8_toxicity(spark, sf).join(spark.read.parquet(sf + "/labels.parquet"), "doc_id").where("held_out").collect()
    score = np.array([r["score"] for r in rows])
    toxic = np.array([r["toxic"] for r in rows]) == 1
    order = np.searchsorted(np.sort(score[~toxic]), score[toxic]).sum() / toxic.sum() / (~toxic).sum()
    assert order > 0.93 and (score[~toxic] >= t.THRESHOLD).mean() < 0.01 and (score[toxic] >= t.THRESHOLD).mean() > 0.5


def test_n_grams_that_share_a_slot_keep_their_values(spark, monkeypatch):
    """With 64 slots nearly every n-gram shares one; open words, a long one and repeats included, equal the plain models."""
    monkeypatch.setattr(t, "SLOTS", {"gram": 6, "context": 5})
    rows = corpus(40)
    counts = t.count_grams(spark.createDataFrame([(x, y) for _, x, y in rows], "text string, toxic int"))
    plain, exact = Plain([(x, y) for _, x, y in rows]), t.exact_ratios(counts)
    model = t.Model(t.tables_of(t.ratios(counts, exact)), exact=exact)
    texts = ["Alpha nasty beta nasty", "alphabet bet", "unseen words", "", None, "a", "alphabeta" * 50, *(x for _, x, _ in rows[:8])]
    docs = spark.createDataFrame([(i % 5, x) for i, x in enumerate(texts)], "row long, text string")
    assert sum(len(model.parts(x)[2]) for x in texts) > 20
    found, ratio = t._with_ratio(docs, model)
    got = sorted(((r["text"] or "", r[ratio]) for r in found.collect()))
    assert [r for _, r in got] == pytest.approx([plain.ratio(x) for x, in sorted((x or "",) for x in texts)], abs=1e-4)
    assert found.columns == ["row", "text", "ratio"]


def test_one_broadcast_of_the_tables(spark, monkeypatch):
    """Every broadcast is a file of 48 MB on the driver and on each executor; the curve and the scores share one."""
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or send(value))
    docs, labels = frames(spark, corpus())
    model = t.train(docs, labels)
    assert len(t.score_toxicity(docs, model).collect()) == len(t.score_toxicity(docs, model, keep_text=False).collect()) == 240
    assert len(sent) == 1 and sent[0] is model.tables


def test_empty_slots_take_no_room(spark, monkeypatch):
    """What the driver gets and sends grows with the n-grams: 1.2 MB and 8 bytes for each taken slot, not 48 MB at once."""
    slotted = t.ratios(t.count_grams(spark.createDataFrame([(x, y) for _, x, y in corpus(40)], "text string, toxic int")))
    taken = {r["kind"]: r["count"] for r in slotted.groupBy("kind").count().collect()}
    tables = t.tables_of(slotted)
    assert {k: len(v["rows"]) for k, v in tables.items()} == taken
    assert len(pickle.dumps(tables)) < 1_200_000 + 8 * sum(taken.values())
    monkeypatch.setattr(t, "_PIECE", 1 << 12)  # in more pieces, which come in another order
    again = t.tables_of(slotted)
    want = {(r["kind"], r["slot"]): (r["value"], r["mark"]) for r in slotted.collect()}
    for made in (tables, again):
        got = {}
        for kind, own in made.items():
            at = np.flatnonzero(np.unpackbits(own["words"].view(np.uint8), bitorder="little"))
            rows = own["rows"][own["before"][at >> 6] + [int(own["words"][i >> 6] & np.uint64((1 << int(i & 63)) - 1)).bit_count() for i in at]]
            got |= {(kind, i): tuple(r) for i, r in zip(at.tolist(), rows.tolist())}
        assert got == want
