"""Byte-level BPE of many texts with the tokenizers library, each distinct piece of text encoded once.

A text is cut where the vocabulary's own pre-tokenizer always cuts: after an ASCII letter that another ASCII character
follows, before a single space and around a single line feed between two characters that aren't white space. The
pieces between such cuts are encoded by the library on their own, which gives the same ids as in the whole text;
repeated pieces are looked up by a 128-bit hash. All of this is done for a block of texts at once.
"""

from __future__ import annotations

import os
from itertools import chain
from pathlib import Path

import numpy as np

from stockaudit.llm.common import worker_state

_JOINED = 64  # new words that the library gets as one text
_CHUNK = 1 << 18  # characters of a text that are handled at once
_MOST_PIECES = 2_000_000  # in the table of known pieces; it starts anew when full

_B = np.arange(256)
_LETTER = ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122))
_ASCII_OTHER = (_B < 128) & ~_LETTER
_SHOWN = (_B >= 0x21) & (_B <= 0x7E)
_LEAD2 = (_B >= 0xC3) & (_B <= 0xDF)  # of two bytes, none of them white space
_STARTS_SHOWN = _SHOWN | _LEAD2 | ((_B >= 0xE4) & (_B <= 0xE9)) | (_B >= 0xF0)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    values = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
    return values[0] | np.uint64(1), values[1] | np.uint64(1)


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class PieceEncoder:
    """Encodes lists of texts; keeps the library's tokenizer and the table of known pieces.

    A ``plain`` one reads the strings of special tokens as ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.bytes_of = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size())], np.int64)
        self.one, self.two = _tables()
        self.up, self.down = powers(1 << 16, _BASE), powers(1 << 16, _INVERSE)
        self._clear()

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """This worker's encoder for the file; a file that isn't there is an error."""
        known = worker_state().setdefault("encoders", {})
        if path not in known:
            known[path] = cls(str(Path(path)))
        return known[path]

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as ``encode(text, add_special_tokens=False).ids`` gives them."""
        parts, owner = [], []
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, text in enumerate(texts):
            if any(t in text for t in self.added):
                out[i].append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32))
                continue
            for part in _chunks(text):
                parts.append(part.encode())
                owner.append(i)
        at = 0
        while at < len(parts):
            upto, size = at, 0
            while upto < len(parts) and (upto == at or size + len(parts[upto]) <= 1 << 20):
                size += len(parts[upto])
                upto += 1
            for i, ids in zip(owner[at:upto], self._block(parts[at:upto])):
                out[i].append(ids)
            at = upto
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]

    def _block(self, parts: list[bytes]) -> list[np.ndarray]:
        whole = b"\0".join([*parts, b""])
        b = np.frombuffer(whole, np.uint8)
        sizes = np.array([len(x) for x in parts], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        marks = _cuts(b)
        marks[first] = True
        marks[first + sizes] = True
        starts = np.flatnonzero(marks)
        ends = np.append(starts[1:], len(b))
        ends = np.minimum(ends, len(b))
        real = np.ones(len(starts), bool)
        real[np.searchsorted(starts, first + sizes)] = False  # the bytes between texts
        starts, ends = starts[real], ends[real]
        if not len(starts):
            return [np.zeros(0, np.int32) for _ in parts]
        keys, checks = self._hashes(b, starts, ends)
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        inverse = np.empty(len(keys), np.int64)
        inverse[order] = np.cumsum(new) - 1
        distinct = order[new]
        if not (checks[distinct][inverse] == checks).all():  # two pieces with one hash
            return [np.array(self.library.encode(x.decode(), add_special_tokens=False).ids, np.int32) for x in parts]
        at, size = self._look_up(b, keys[distinct], checks[distinct], starts[distinct], ends[distinct])
        size, at = size[inverse], at[inverse]
        upto = np.cumsum(size)
        ids = self.pool[np.repeat(at - (upto - size), size) + np.arange(upto[-1])]
        pieces = np.searchsorted(starts, first + sizes)
        return np.split(ids, np.concatenate([[0], upto])[pieces][:-1])

    def _hashes(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < len(b):
            n = len(b) + (len(b) >> 3)
            self.up, self.down = powers(n, _BASE), powers(n, _INVERSE)
        out = []
        for values in (self.one, self.two):
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(values[b] * self.up[:len(b)], out=total[1:])
            h = (total[ends] - total[starts]) * self.down[starts]
            out.append(h ^ (h >> np.uint64(31)))
        return out[0], out[1] + (ends - starts).astype(np.uint64)

    def _look_up(self, b: np.ndarray, keys, checks, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of each distinct piece; ``keys`` ascend."""
        place = np.searchsorted(self.keys, keys)
        near = np.minimum(place, max(0, len(self.keys) - 1))
        known = (self.keys[near] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        if known.any() and not (self.checks[near][known] == checks[known]).all():
            self._clear()  # a piece with the hash of another: forget the others
            return self._look_up(b, keys, checks, starts, ends)
        if len(self.keys) + (~known).sum() > _MOST_PIECES and len(self.keys):
            self._clear()
            return self._look_up(b, keys, checks, starts, ends)
        at, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[known], size[known] = self.at[near[known]], self.size[near[known]]
        miss = np.flatnonzero(~known)
        if len(miss):
            words = self._is_word(b, starts[miss], ends[miss])
            miss = np.concatenate([miss[words], miss[~words]])
            n = int(words.sum())
            flat, size[miss[:n]] = self._encode_words(b, starts[miss[:n]], ends[miss[:n]])
            rest, size[miss[n:]] = self._encode_each([b[s:e].tobytes().decode() for s, e in zip(starts[miss[n:]], ends[miss[n:]])])
            flat = np.concatenate([flat, rest])
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used:self.used + len(flat)] = flat
            at[miss] = self.used + np.cumsum(size[miss]) - size[miss]
            self.used += len(flat)
            miss = np.sort(miss)
            self.keys = np.insert(self.keys, place[miss], keys[miss])
            self.checks = np.insert(self.checks, place[miss], checks[miss])
            self.at = np.insert(self.at, place[miss], at[miss])
            self.size = np.insert(self.size, place[miss], size[miss])
        return at, size


    @staticmethod
    def _is_word(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which pieces are a space and ASCII letters."""
        letters = np.concatenate([[0], np.cumsum(_LETTER[b])])
        return (b[starts] == 32) & (ends - starts > 1) & (letters[ends] - letters[starts] == ends - starts - 1)

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(made), np.int32), np.fromiter(map(len, made), np.int64, len(made))

    def _encode_words(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of many words, of which the library gets ``_JOINED`` as one text: it cuts before every space.

        The bytes that each id spells tell which word it belongs to.
        """
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        size = ends - starts
        upto = np.cumsum(size)
        text = b[np.repeat(starts - (upto - size), size) + np.arange(upto[-1])].tobytes().decode("ascii")
        cuts = [0, *upto[_JOINED - 1::_JOINED].tolist(), len(text)]
        flat, _ = self._encode_each([text[a:z] for a, z in zip(cuts[:-1], cuts[1:])])
        spelt = np.cumsum(self.bytes_of[flat])
        last = np.searchsorted(spelt, upto)
        if last[-1] >= len(spelt) or not (spelt[last] == upto).all():  # an id that goes over a word's end
            return self._encode_each([text[z - n:z] for z, n in zip(upto.tolist(), size.tolist())])
        return flat, np.diff(last, prepend=-1)


def _cuts(b: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte."""
    n = len(b)
    marks = np.zeros(n + 1, bool)
    if n < 2:
        return marks[:n]
    letter = _LETTER[b]
    marks[1:n] = letter[:-1] & _ASCII_OTHER[b[1:]]
    shown_before = np.zeros(n, bool)  # the character before isn't white space
    shown_before[1:] = _SHOWN[b[:-1]]
    shown_before[2:] |= (b[1:-1] >= 0x80) & _LEAD2[b[:-2]]
    shown_after = np.zeros(n, bool)
    shown_after[:-1] = _STARTS_SHOWN[b[1:]]
    alone = shown_before & shown_after
    space, line = alone & (b == 32), np.flatnonzero(alone & (b == 10))
    marks[:n] |= space
    marks[line] = True
    marks[line + 1] = True
    return marks[:n]


def _chunks(text: str) -> list[str]:
    """The text in parts of about ``_CHUNK`` characters, cut before a space that follows an ASCII letter, where there is one."""
    out, at = [], 0
    while len(text) - at > _CHUNK:
        cut = text.rfind(" ", at + 1, at + _CHUNK)
        while cut > at and not (text[cut - 1].isascii() and text[cut - 1].isalpha()):
            cut = text.rfind(" ", at + 1, cut)
        if cut <= at:
            break
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out
