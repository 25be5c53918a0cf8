"""Operator 3: base spans against the plain patterns, decoded layers with their spans, cycles and bounds."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import zlib
from urllib.parse import quote

from stockaudit.llm import secrets

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans():
    r = random.Random(1)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "Secret", "toKen", "ſecret", ":", "=", " ", '"', "'", "abcd1234", "x",
             "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "é", "\n", "-", "/", "token: token", "=="]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(0, 12)))
        assert secrets.find(text) == plain(text), text


SECRET = "token = 'abcd1234efgh5678'"


def spans(text):
    return [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.scan(text)[1]]


def test_layers():
    b64 = lambda s: base64.b64encode(s if isinstance(s, bytes) else s.encode()).decode()
    assert spans("say " + quote(SECRET, safe="") + " end") == [("assign", "token%20%3D%20%27abcd1234efgh5678")]
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    assert spans("x " + escaped + " y") == [("assign", escaped[:-6])]
    assert spans("x " + "".join(f"\\x{ord(c):02x}" for c in SECRET))[0][0] == "assign"
    for inner in (b64(SECRET), b64(gzip.compress(SECRET.encode())), b64(zlib.compress(SECRET.encode())),
                  b64(gzip.compress(zlib.compress(SECRET.encode()))), b64(b64(b64(SECRET)))):
        assert spans(f"see {inner} there") == [("assign", inner)]
    nested = quote(b64(quote(escaped, safe="")).replace("A", "%41"), safe="")
    assert [k for k, _ in spans(f"a {nested} b")] == ["assign"]
    both = f"{SECRET} {b64(SECRET)} {b64(SECRET)}"
    assert [k for k, _ in spans(both)] == ["assign"] * 3


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def test_values_behind_separators():
    packed = b64(gzip.compress(SECRET.encode()))
    for inner in (b64("password=hunter2hunter2"), b64(SECRET), packed):
        for front in ("payload=", "x=", "data/", "a/b/c/", "see://host/path-of/", "key_", "=", "q=a-b_"):
            got = spans(f"go {front}{inner} on")
            assert ("assign", inner) in got or ("assign", inner.rstrip("=")) in got, (front, inner, got)
    # Starts that share their bytes with an earlier one, and a run in which no start can be read.
    for n in range(12):
        assert ("assign", b64(SECRET)) in spans("z" * n + "/" + b64(SECRET))
    assert spans("/".join(["qqqqqqq"] * 3000)) == []


def test_runs_with_bad_units():
    code = quote(SECRET, safe="").replace("token", "%74%6f%6b%65%6e")
    assert spans("a %ff" + code + " b")[0][0] == "assign"
    every = "".join(f"%{x:02x}" for x in SECRET.encode())
    assert spans("a %ff" + every + "%fe b") == [("assign", every[:-3])]
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    assert spans("a \\ud800" + escaped + "\\udc00 b") == [("assign", escaped[:-6])]
    assert secrets.scan("%ff%fe \\ud800")[2] == 0


def test_base64_over_lines():
    inner = b64("some words ahead of it, " * 6 + SECRET + " and some behind " * 6)
    for width in (60, 64, 76):
        for end in ("\n", "\r\n", "\n    "):
            lines = end.join(inner[i:i + width] for i in range(0, len(inner), width))
            assert ("assign", lines) in spans(f"key:\n{lines}\n\nnext")
    whole = b64(b"x" * 45 + SECRET.encode() + b" ok!")  # no padding, so that the next word looks like a line of it
    assert not whole.endswith("=")
    lines = "\n".join(whole[i:i + 40] for i in range(0, len(whole), 40))
    assert ("assign", lines) in spans(f"{lines}\nword")
    assert spans("internationalisation\ntelecommunications\nwords") == []


def nested(r, depth):
    """A secret under ``depth`` encodings, drawn at random."""
    value = SECRET
    for _ in range(depth):
        value = r.choice([
            lambda v: quote(v, safe=""), lambda v: "".join(f"%{x:02X}" for x in v.encode()), b64,
            lambda v: "".join(f"\\u{ord(c):04x}" for c in v), lambda v: "".join(f"\\x{ord(c):02x}" for c in v),
            lambda v: base64.urlsafe_b64encode(v.encode()).decode(), lambda v: b64(gzip.compress(v.encode())),
            lambda v: b64(zlib.compress(v.encode())),
        ])(value)
    return value


def test_bounds_change_no_span():
    r = random.Random(8)
    words = ["token = ", "abcd1234efgh", "password:", " ", "\n", "plain words here. ", "é", SECRET, "0123456789abcdef" * 2, b64(SECRET), "}\n"]
    for _ in range(300):
        text = b64(gzip.compress("".join(r.choices(words, k=r.randint(5, 60))).encode()))
        assert secrets.scan(text, bound=300)[1] == secrets.scan(text)[1]
    members = b64(gzip.compress(b"some words ") + gzip.compress(SECRET.encode()))
    assert spans(f"see {members} there") == [("assign", members)]


def test_recall_over_planted_nestings():
    r, found = random.Random(5), 0
    for _ in range(600):
        value = nested(r, r.randint(1, 4))
        front = r.choice(["", "text ", "payload=", "v/", "data: ", "url?x=", '"', "%ff "])
        text = f"some words {front}{value} and more"
        at = text.index(value)
        found += any(k == 0 and a < at + len(value) and b > at for a, k, b in secrets.scan(text)[1])
    assert found >= 0.98 * 600, found


def test_cycles_bounds_and_plain_text():
    assert secrets.scan("%25" * 50)[2] < 60 and secrets.scan("%2525252541")[2] == 5
    big = base64.b64encode(zlib.compress(b"a " * 5000 + SECRET.encode())).decode()
    assert secrets.scan(big)[3] is False and len(secrets.scan(big)[1]) == 1
    # Layers of bounded length find the same; a run longer than the bound is cut, and both parts are read.
    assert secrets.scan(big, bound=100)[1] == secrets.scan(big)[1] and secrets.scan(big, bound=100)[3] is False
    run = base64.b64encode(gzip.compress(b"q" * 5000 + b" " + SECRET.encode())).decode()
    assert secrets.scan(run, bound=100)[3] is True and secrets.scan(run, bound=100)[1] == secrets.scan(run)[1] != []
    assert secrets.scan("just words, internationalisation of telecommunications")[1:3] == ([], 0)
    assert secrets.scan(None) == ([], [], 0, False)
    assert secrets.scan("\\ud800 %ff%fe " + "A" * 17)[1] == []


def test_operator(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, SECRET, "y"), (3, SECRET, "y"), (None, "é😀 " + SECRET, "z"), (5, "w " * 60_000 + SECRET, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.scan_secrets(docs)
    assert found.columns == ["doc_id", "text", "spans", "n_assign", "n_access", "n_hex", "base_spans", "spans_", "n_layers", "truncated"]
    got = [(r["doc_id"], r["n_assign"], r["base_spans"]) for r in found.collect()]
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "assign:0:25"), (3, 1, "assign:0:25"), (None, 1, "assign:3:28"), (5, 1, "assign:120000:120025")]
    masked = [r["text"] for r in secrets.mask_secrets(docs).collect()]
    assert masked[2] == "*" * 25 + "'" and masked[0] is None and masked[4] == "é😀 " + "*" * 25 + "'"
    assert secrets.scan_secrets(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(sf + "/documents.parquet").collect()}
    rows = secrets.op3_secret_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        written = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))
