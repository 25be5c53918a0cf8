"""CRC-32 of many byte spans at once, by a table of every byte value's contribution at every distance from the span's end.

CRC-32 is linear but for its start value: the checksum of a span is the XOR of what each byte contributes, given its value and
its distance from the end, and of a constant for the length. ``bitwise_xor.reduceat`` folds the contributions of all
spans in one call. Spans longer than the table are cut into blocks from the end; the state after one block is carried
over the next by the same table.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256  # distances in the table
_AT_ONCE = 1 << 20  # bytes whose contributions are in memory at a time
_ONES = np.uint32(0xFFFFFFFF)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Contributions [distance, byte], and the state after each number of zero bytes from the start value."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    step = lambda s: one[s & np.uint32(255)] ^ (s >> np.uint32(8))
    table, after = [one], [np.array([_ONES])]
    for _ in range(BLOCK):
        table.append(step(table[-1]))
        after.append(step(after[-1]))
    return np.stack(table[:BLOCK]), np.concatenate(after)


class PositionCrc:
    def __init__(self):
        self.table, self.after = _tables()

    def of(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of every span ``data[start:start + size]``; sizes may be 0."""
        blocks = np.maximum(1, -(-sizes // BLOCK))
        head = sizes - (blocks - 1) * BLOCK  # the first block is the short one
        last = np.cumsum(blocks) - 1
        first = last - (blocks - 1)
        at = np.repeat(starts + head, blocks) + (np.arange(last[-1] + 1 if len(last) else 0) - np.repeat(first, blocks) - 1) * BLOCK
        width = np.full(len(at), BLOCK, np.int64)
        at[first], width[first] = starts, head
        part = self._linear(data, at, width)
        state = self.after[head] ^ part[first]
        more = np.flatnonzero(blocks > 1)
        more = more[np.argsort(-blocks[more], kind="stable")]  # the longest spans first
        for k in range(1, int(blocks[more[0]]) if len(more) else 0):
            more = more[:np.searchsorted(-blocks[more], -k, "left")]
            state[more] = self._carry(state[more]) ^ part[first[more] + k]
        return state ^ _ONES

    def _carry(self, state: np.ndarray) -> np.ndarray:
        """The states after a block of zero bytes: the four bytes of a state act like the first four of the block."""
        out = self.table[BLOCK - 1][state & np.uint32(255)]
        for n in (1, 2, 3):
            out = out ^ self.table[BLOCK - 1 - n][(state >> np.uint32(8 * n)) & np.uint32(255)]
        return out

    def _linear(self, data: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint32)
        full = np.flatnonzero(width)
        upto = np.cumsum(width[full])
        cuts = np.searchsorted(upto, np.arange(_AT_ONCE, (upto[-1] if len(upto) else 0) + _AT_ONCE, _AT_ONCE), "right")
        low = 0
        for high in cuts.tolist():
            some = full[low:high]
            low = high
            if not len(some):
                continue
            n = width[some]
            ends = np.cumsum(n)
            begin = ends - n
            place = np.arange(ends[-1])
            byte = data[place + np.repeat(at[some] - begin, n)]
            away = np.repeat(ends, n) - place - 1
            out[some] = np.bitwise_xor.reduceat(self.table[away, byte], begin)
        return out
