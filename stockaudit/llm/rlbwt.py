"""Run-length index over a block of symbols: suffix array, run-compressed Burrows-Wheeler transform, matching statistics.

The transform is cut into runs of equal symbols; the suffix array is kept at the first and last row of each run only. From these
samples the longest match of every suffix with another one follows: next to a run's border the match is compared
symbol by symbol, and inside a run it is one shorter than at the position before, so the statistics are streamed over
the text from sample to sample.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` (non-negative numbers) in order, by prefix doubling; only unresolved ones are sorted again."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    bits = max(1, int(s.max() + 1).bit_length())
    per = max(1, 62 // bits)
    key = packed(s, bits, per)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(2 * n + per, np.int64)
    rank[order] = start + 1
    h = per
    while True:
        tied = np.zeros(n, bool)
        same = start[1:] == start[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        place = np.flatnonzero(tied)
        if not len(place):
            return order
        these = order[place]
        both = start[place] * (n + 2) + rank[np.minimum(these + h, 2 * n)]
        by = np.argsort(both, kind="stable")
        these, both = these[by], both[by]
        order[place] = these
        new = np.concatenate([[True], both[1:] != both[:-1]])
        start[place] = np.maximum.accumulate(np.where(new, place, 0))
        rank[these] = start[place] + 1
        h *= 2


def packed(s: np.ndarray, bits: int, per: int) -> np.ndarray:
    """``per`` symbols from each position on in one number; positions behind the end count as 0, symbols as one more."""
    n = len(s)
    padded = np.concatenate([s.astype(np.int64) + 1, np.zeros(per, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(per):
        key = key << bits | padded[j:n + j]
    return key


class RunLengthIndex:
    """Runs of the transform of ``s`` and the suffixes at their borders."""

    def __init__(self, s: np.ndarray):
        self.s = np.asarray(s, np.int64)
        order = suffix_array(self.s)
        before = np.where(order > 0, self.s[order - 1], -1)  # nothing is before the whole text
        head = np.concatenate([[True], before[1:] != before[:-1]]) if len(order) else np.zeros(0, bool)
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(order)) - 1 if len(heads) else heads
        self.symbols = before[heads]  # of each run
        self.lengths = tails - heads + 1
        self.first, self.last = order[heads], order[tails]  # the sampled run ends

    def matching_statistics(self, most: int) -> np.ndarray:
        """For every position the length, up to ``most``, of the longest match of its suffix that starts elsewhere."""
        n = len(self.s)
        if n < 2:
            return np.zeros(n, np.int64)
        border = common_lengths(self.s, self.last[:-1], self.first[1:])
        out = np.zeros(n, np.int64)
        for at, to in ((self.first[1:], border), (self.last[:-1], border)):  # neighbours in front, and behind
            ahead = np.full(n, -1, np.int64)
            ahead[at] = to + at
            out = np.maximum(out, np.maximum.accumulate(ahead) - np.arange(n))
        return np.minimum(out, most)


def common_lengths(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at a and b share."""
    bits = max(1, int(s.max() + 1).bit_length())
    per = max(1, 62 // bits)
    n = len(s)
    key = np.concatenate([packed(s, bits, per), np.zeros(per, np.int64)])
    plain = np.concatenate([s, np.full(per, -1)])
    shared = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    while len(going):
        at = shared[going]
        same = (key[np.minimum(a[going] + at, n)] == key[np.minimum(b[going] + at, n)]) & (np.maximum(a[going], b[going]) + at + per <= n)
        shared[going[same]] += per
        rest = going[~same]
        for _ in range(per):  # the packed symbols differ somewhere, or the text ends
            x, y = a[rest] + shared[rest], b[rest] + shared[rest]
            ok = (np.maximum(x, y) < n) & (plain[np.minimum(x, n)] == plain[np.minimum(y, n)])
            rest = rest[ok]
            shared[rest] += 1
        going = going[same]
    return shared
