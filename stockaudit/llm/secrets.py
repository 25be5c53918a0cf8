"""Secret scans with a recursive decoding worklist (operator 3).

The text is scanned with three patterns. Then the worklist starts: every encoded stretch of a layer (percent
sequences, Unicode or hexadecimal escapes, base64, and gzip or zlib data inside base64) is decoded into a new layer, each
new layer is scanned and searched for encoded stretches again, until nothing new appears. A layer whose content has been
seen on the way down is not entered again, so cycles end. Every decoded character knows the stretch of the layer above
that it came from, so that a finding is reported as a span of the original text.

Base64 may follow ``=``, ``/`` or any other separator (``payload=...``, ``data/...``): a run is read from its start or from the
first separator behind which it is text or compressed data. Base64 broken over lines is read as one run. A byte that
isn't UTF-8 in a percent run and a lone surrogate among escapes stay as they are; the rest of the run is decoded.

Defined results: a null or empty text has no span. Rows pass one by one, so repeated rows and ties of ``doc_id`` change
nothing; extra columns stay as they are. Decompressed data is read to its end, in layers of about ``bound`` characters,
one in memory at a time for each depth, which are cut where no span and no encoded run can cross. Only where there is no
such place for ``bound`` characters on end is a run cut; ``truncated`` says so, and both parts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stockaudit.llm.common import free_name, table, texts_of, through_arrow

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so shorter ones need no match of their own

ESCAPED = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
#: Lines of 16 or more characters of base64, then one of any length. A match starts and ends where lines of base64 do.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\r?\n[\x20\t]*)+[A-Za-z0-9+/_-]++={0,2}")
SEPARATOR = re.compile(r"[+/_-]")
CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]")
#: Places no match goes across: blanks between two words, and line ends behind a character that base64 doesn't have.
SAFE = re.compile(r"(?<=[^\s:=])[\x20\t]+(?=[^\s:=])|(?<=[^\sA-Za-z0-9+/_=-])\r?\n")
SHORTEST = 16
LAYER = 64 << 20


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans of one layer, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text. Pieces (start here, start above, characters above) map its positions to the layer above.

    In a plain piece characters correspond one to one; in any other, each stands for the whole stretch above.
    """

    def __init__(self, text: str, pieces: list[tuple[int, int, int, bool]], above: Layer | None, seen: frozenset[bytes]):
        self.text, self.pieces, self.above, self.seen = text, pieces, above, seen
        self.starts = [p[0] for p in pieces]

    def lift(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that [start, end) of this layer came from."""
        layer = self
        while layer.above is not None:
            here, up, n, plain = layer.pieces[bisect_right(layer.starts, start) - 1]
            last, up2, n2, plain2 = layer.pieces[bisect_right(layer.starts, end - 1) - 1]
            start = up + (start - here if plain else 0)
            end = up2 + (end - last if plain2 else n2)
            layer = layer.above
        return start, end


def _unescape(text: str) -> tuple[str, list[tuple[int, int, int, bool]]] | None:
    """The text with its percent sequences and escapes decoded, and the pieces; None if nothing can be decoded."""
    out, pieces, at, size = [], [], 0, 0
    for m in ESCAPED.finditer(text):
        units = _percent(m[0]) if m[0][0] == "%" else _escapes(m[0])
        if units is None:
            continue
        if m.start() > at:
            out.append(text[at:m.start()])
            pieces.append((size, at, m.start() - at, True))
            size += m.start() - at
        up = m.start()
        for chars, width in units:
            out.append(chars)
            pieces.append((size, up, width, False))
            size += len(chars)
            up += width
        at = m.end()
    if not pieces:
        return None
    if at < len(text):
        out.append(text[at:])
        pieces.append((size, at, len(text) - at, True))
    return "".join(out), pieces


def _percent(run: str) -> list[tuple[str, int]] | None:
    data = bytes.fromhex(run.replace("%", ""))
    out, at, good = [], 0, False
    for c in data.decode("utf-8", "surrogateescape"):
        if 0xDC80 <= ord(c) <= 0xDCFF:  # a byte that isn't UTF-8 stays as it is written
            out.append((run[at:at + 3], 3))
        else:
            good = True
            out.append((c, 3 * len(c.encode())))
        at += out[-1][1]
    return out if good else None


def _escapes(run: str) -> list[tuple[str, int]] | None:
    units = re.findall(r"\\u....|\\x..", run)
    out, i, good = [], 0, False
    while i < len(units):
        code, written = int(units[i][2:], 16), units[i]
        if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= (low := int(units[i + 1][2:], 16)) < 0xE000:
            code, written, i = 0x10000 + ((code - 0xD800) << 10) + low - 0xDC00, written + units[i + 1], i + 1
        if 0xD800 <= code < 0xE000:  # a lone surrogate isn't text and stays as it is written
            out.append((written, len(written)))
        else:
            good = True
            out.append((chr(code), len(written)))
        i += 1
    return out if good else None


def _compressed(data: bytes) -> bool:
    """Whether data begin as gzip or zlib data do."""
    return data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0)


def _inflate(blocks: Iterator[bytes], size: int) -> Iterator[bytes]:
    """gzip or zlib data decompressed, in blocks of at most ``size``; gzip members that follow each other are one."""
    unpacker = zlib.decompressobj(zlib.MAX_WBITS | 32)
    for block in blocks:
        while block:
            if out := unpacker.decompress(block, size):
                yield out
            block = unpacker.unconsumed_tail
            if unpacker.eof:
                block = unpacker.unused_data
                if block[:2] != b"\x1f\x8b":
                    return
                unpacker = zlib.decompressobj(zlib.MAX_WBITS | 32)


def _unpack(data: bytes, size: int) -> Iterator[bytes]:
    """The data in blocks, decompressed as often as they are compressed."""
    head, rest, seen = data, iter(()), set()
    # Data that decompress to themselves end here: levels with equal first blocks go on with equal first blocks.
    while _compressed(head) and (mark := hashlib.blake2b(head, digest_size=16).digest()) not in seen:
        seen.add(mark)
        inner = _inflate(chain([head], rest), size)
        try:
            head, rest = next(inner, b""), inner
        except zlib.error:
            break
    yield head
    yield from rest


def _bytes_of(run: str) -> bytes | None:
    body = run.rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _texts_of(data: bytes, bound: int) -> Iterator[tuple[str, bool]]:
    """Decoded bytes as texts of about ``bound`` characters, and whether a run was cut behind each; none if they are no text."""
    decoder, text = codecs.getincrementaldecoder("utf-8")(), ""
    try:
        for block in _unpack(data, bound):
            if CONTROL.search(block):
                return
            text += decoder.decode(block)
            while len(text) > bound:
                cut = max((m.end() for m in SAFE.finditer(text)), default=0)
                if not cut and len(text) < 2 * bound:
                    break  # the run may end in the next block
                yield text[:cut or bound], not cut
                text = text[cut or bound:]
        text += decoder.decode(b"", final=True)
    except (UnicodeDecodeError, zlib.error):
        return
    if text:
        yield text, False


def _unbase64(run: str, bound: int) -> Iterator[tuple[int, str, bool]]:
    """Where in a run of base64 characters the data start, and their texts with whether a run was cut behind each.

    The data start with the run or behind one of its separators. The bytes of a start are the tail of those of any start a
    multiple of four before it, so four decodings serve all starts; a start is read only if its bytes look like compressed
    data or lie behind the last byte that can't be in a text.
    """
    body = run.rstrip("=")
    phases: dict[int, tuple[int, bytes, int]] = {}
    for start in [0, *(m.end() for m in SEPARATOR.finditer(body))]:
        if len(body) - start < SHORTEST:
            return
        if (len(body) - start) % 4 == 1:
            continue
        if start % 4 not in phases:
            data = _bytes_of(body[start:]) or b""
            phases[start % 4] = start, data, _unreadable(data)
        first, data, bad = phases[start % 4]
        at, found = (start - first) // 4 * 3, False
        if at > bad or _compressed(data[at:at + 2]):
            for text, cut in _texts_of(data[at:], bound):
                found = True
                yield start, text, cut
        if found:
            return


def _unreadable(data: bytes) -> int:
    """A place up to which, itself included, no tail of ``data`` is a text: the last bad byte, -1 if there is none."""
    bad = -1
    for m in CONTROL.finditer(data):
        bad = m.start()
    tail = data[bad + 1:].decode("utf-8", "surrogateescape")
    last = max((i for i, c in enumerate(tail) if "\udc80" <= c <= "\udcff"), default=-1)
    return bad if last < 0 else bad + len(tail[:last + 1].encode("utf-8", "surrogateescape"))


def _wrapped(run: str, bound: int) -> Iterator[tuple[int, str, bool]]:
    """The end of base64 data broken over lines, and their texts with whether a run was cut behind each."""
    lines, found = re.split(r"(\r?\n[\x20\t]*)", run), False
    for kept in (lines, lines[:-2]):  # the last line may be a word that follows the data
        if not found and len(kept) > 1 and (data := _bytes_of("".join(kept[::2]))):
            for text, cut in _texts_of(data, bound):
                found = True
                yield len("".join(kept)), text, cut


def below(layer: Layer, bound: int) -> Iterator[tuple[Layer, bool]]:
    """The layers one decoding below that were not seen on the way down, and whether a run was cut behind each."""
    text = layer.text

    def inner(decoded: str, pieces, cut: bool = False) -> Iterator[tuple[Layer, bool]]:
        mark = _mark(decoded)
        if mark not in layer.seen:
            yield Layer(decoded, pieces, layer, layer.seen | {mark}), cut

    if ("%" in text or "\\" in text) and (got := _unescape(text)):
        yield from inner(*got)
    for m in BASE64.finditer(text):
        for start, decoded, cut in _unbase64(m[0], bound):
            yield from inner(decoded, [(0, m.start() + start, m.end() - m.start() - start, False)], cut)
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            for end, decoded, cut in _wrapped(m[0], bound):
                yield from inner(decoded, [(0, m.start(), end, False)], cut)


def scan(text: str | None, bound: int = LAYER) -> tuple[list, list, int, bool]:
    """Base spans, all spans of the original text, the number of layers, and whether a run was cut."""
    text = text or ""
    base = find(text)
    spans, layers, cut = set(base), 0, False
    work = [below(Layer(text, [], None, frozenset([_mark(text)])), bound)]
    while work:
        got = next(work[-1], None)
        if got is None:
            work.pop()
            continue
        layer, short = got
        layers, cut = layers + 1, cut or short
        for start, kind, end in find(layer.text):
            a, b = layer.lift(start, end)
            spans.add((a, kind, b))
        work.append(below(layer, bound))
    return base, sorted(spans), layers, cut


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FIELDS = ("n_assign long, n_access long, n_hex long, base_spans string, spans string, n_layers long, truncated boolean")


def scan_secrets(docs: DataFrame, text: str = "text", bound: int = LAYER) -> DataFrame:
    """``docs`` and, per row, the counts of base spans by kind, base spans, all spans, layers entered, truncated."""
    names = [free_name(docs, f.split()[0]) for f in FIELDS.split(", ")]
    fields = ", ".join(f"`{n}` {f.split()[1]}" for n, f in zip(names, FIELDS.split(", ")))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = []
        for x in texts_of(batch, text):
            base, spans, layers, cut = scan(x, bound)
            kinds = [k for _, k, _ in base]
            rows.append((*(kinds.count(k) for k in range(3)), _written(base), _written(spans), layers, cut))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.bool_()]
        columns = list(zip(*rows)) or [()] * 7
        return {n: pa.array(list(c), t) for n, c, t in zip(names, columns, types)}

    return through_arrow(docs, fields, work)


def mask_secrets(docs: DataFrame, text: str = "text", mask: str = "*") -> DataFrame:
    """``docs`` with every character of every span, decoded layers included, replaced by ``mask``."""
    kind = docs.schema
    names = docs.columns

    def masked(value: str | None) -> str | None:
        if value is None:
            return None
        out, at = [], 0
        for start, _, end in scan(value)[1]:
            if end > at:
                out += [value[at:max(at, start)], mask * (end - max(at, start))]
                at = end
        return "".join(out) + value[at:] if out else value

    def each(batches):
        for batch in batches:
            columns = list(batch.columns)
            i = batch.schema.names.index(text)
            columns[i] = pa.array([masked(x) for x in texts_of(batch, text)], columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(each, kind)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "n_assign", "n_access", "n_hex", "sha2(base_spans, 256) base_sha256", "spans",
                            "n_layers", "truncated")
