"""Operator 9 against a loop over all rules, and against its DuckDB statement."""

from __future__ import annotations

import random

import duckdb
import pytest

from stockaudit.llm import url_rules as u


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = rest[:min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))]
    path = rest[len(host):]
    path = path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain(pages, rules, default="allow"):
    out = []
    for page, url in pages:
        host, path = plain_parts(url)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((page, host, path, best and best[2], best[3] if best else default))
    return sorted(out, key=str)


def run(spark, pages, rules=u.RULES):
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, rule string")
    made = u.rules_frame(spark, rules) if rules else u.rules_frame(spark).limit(0)
    return sorted((tuple(r) for r in u.judge_urls(frame, made).collect()), key=str)


def pages(seed):
    r = random.Random(seed)
    hosts = ["a.example.org", "Example.ORG", "example.org", "notexample.org", "org", "xorg", "com", "b.c.com", "", "a..com", ".com", "é.com"]
    tails = ["", "/", "/es/", "/es/1", "/en/1", "/en/12?x=/fr/", "/en/2", "/fr/", "/fr/é😀", "/de/#/fr/", "?/fr/", "#x", "/fr", "//", "/fr/://x"]
    out = [(i, r.choice(["http://", "HTTPS://", "", "x://"]) + r.choice(hosts) + r.choice(tails)) for i in range(400)]
    return out + [(1, out[1][1]), (None, "http://example.org/es/"), (500, None), (501, ""), (502, "://"),
                  (503, "http://" + "a." * 300 + "com/fr/" + "z" * 5000)]


def test_production_rules(spark):
    assert run(spark, pages(1)) == plain(pages(1), u.RULES)


def test_many_rules(spark):
    r = random.Random(4)
    rules = {(r.choice(["org", "com", "example.org", "a.example.org", "b.c.com"]), r.choice(["", "/", "/e", "/en/", "/en/1", "/fr/é"])):
             r.choice(["allow", "block"]) for _ in range(40)}
    rows = [(h, p, v) for (h, p), v in rules.items()]
    twice = rows + [(rows[0][0], rows[0][1], "allow"), rows[1]]
    want = [(h, p, "block" if (h, p, "block") in twice else v) for h, p, v in rows]
    assert run(spark, pages(2), twice) == plain(pages(2), want)


def test_empty(spark):
    assert run(spark, []) == [] and {r[3] for r in run(spark, pages(3), [])} == {None}
    with pytest.raises(ValueError):
        run(spark, pages(3), [("com", "/" * 3000, "block")])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_statement(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '/root/testdata/{sf}/pages.parquet'")
    cursor = con.execute(u.SQL)
    names = [d[0] for d in cursor.description]
    got = u.op9_url_rules(spark, f"/root/testdata/{sf}")
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(cursor.fetchall(), key=str)
