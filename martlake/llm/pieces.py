"""Texts cut into pieces that a byte-level BPE encodes independently, and a cache of them.

The cuts are places where the public pre-tokenizer pattern always ends a match: before white
space that follows a visible character, between an ASCII letter and ASCII punctuation, and
between a single line end and an ASCII letter (of a longer run of white space the pattern's
last match depends on what follows). Strings that a library treats as one token are never cut.
A piece may still hold several matches; whoever encodes a piece splits it by the pattern. Words
repeat, so a worker encodes each distinct piece once and looks the rest up by 64-bit hash; the
cache is bounded and refilled when full.
"""

from __future__ import annotations

import numpy as np

from martlake.llm import textkit as tk

#: distinct pieces a worker remembers (about 100 bytes each)
REMEMBER = 1_200_000

_SPACE, _LETTER, _PUNCT, _OTHER, _HIGH = 0, 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)  # digits, control characters and the like: no cut there
_KIND[[0x20, 0x09, 0x0A, 0x0D]] = _SPACE
for _a, _b in ((65, 91), (97, 123)):
    _KIND[_a:_b] = _LETTER
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _KIND[_a:_b] = _PUNCT
_KIND[128:] = _HIGH


def cut(buf: np.ndarray, off: np.ndarray, literals: tuple[bytes, ...] = ()) -> np.ndarray:
    """Starts of all pieces, in order, and the end of the buffer. Every document that isn't
    empty starts a piece; no piece starts inside one of ``literals``."""
    if not len(buf):
        return np.zeros(1, np.int64)
    kind = _KIND[buf]
    before, here = kind[:-1], kind[1:]
    # the last byte of a two-byte letter (lead byte C3 to DF) is no white space
    lead = np.zeros(len(buf) - 1, bool)
    lead[1:] = (before[1:] == _HIGH) & (buf[:-2] >= 0xC3) & (buf[:-2] <= 0xDF)
    visible = (before == _LETTER) | (before == _PUNCT) | lead
    line = (buf[:-1] == 0x0A) & (here == _LETTER)
    line[:1] = False
    line[1:] &= visible[:-1]
    edge = np.zeros(len(buf) + 1, bool)
    edge[1:-1] = ((here == _SPACE) & visible) | ((before == _LETTER) & (here == _PUNCT)) | line
    raw = buf.tobytes() if literals else b""
    for literal in literals:
        i = raw.find(literal)
        while i >= 0:
            edge[i + 1:i + len(literal)] = False
            i = raw.find(literal, i + 1)
    edge[off[:-1][np.diff(off) > 0]] = True
    edge[-1] = True
    return np.flatnonzero(edge)


def _grown(held: np.ndarray | None, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` behind its first ``used`` values; its room doubles when it ends."""
    if held is None or used + len(more) > len(held):
        wide = np.empty(max(1 << 16, 2 * (used + len(more))), more.dtype)
        if used:
            wide[:used] = held[:used]
        held = wide
    held[used:used + len(more)] = more
    return held


class PieceCache:
    """Distinct pieces by hash, each with its encoding: rows of ``self.columns``, arrays of
    concatenated values with offsets."""

    def __init__(self, encode, n_columns: int = 1, remember: int = REMEMBER, literals: tuple[bytes, ...] = ()):
        """``encode(list of bytes)`` returns for each of n_columns a list of one array for each piece,
        or (their values one after another, number of values of each)."""
        self.encode, self.n, self.remember, self.literals = encode, n_columns, remember, literals
        self.clear()

    def clear(self):
        # two sorted runs of hashes with their slots: new ones go to the short run, which is
        # merged into the long one when it has a quarter of its length
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.count = 0
        self.values = [None] * self.n
        self.offsets = [np.zeros(1, np.int64) for _ in range(self.n)]

    def look_up(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The slot of every piece; pieces not seen yet are encoded."""
        if self.count > self.remember:
            self.clear()
        h = tk.span_hashes(buf, bounds[:-1], bounds[1:])
        u, one, each = np.unique(h, return_index=True, return_inverse=True)
        slot = np.full(len(u), -1)
        for keys, slots in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
                known = keys[at] == u
                slot[known] = slots[at[known]]
        fresh = slot < 0
        if fresh.any():
            raw = buf.tobytes()
            new = [raw[bounds[i]:bounds[i + 1]] for i in one[fresh]]
            slot[fresh] = np.arange(self.count, self.count + len(new))
            for k, rows in enumerate(self.encode(new)):
                used = int(self.offsets[k][self.count])
                values, n = rows if isinstance(rows, tuple) else (np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows)))
                self.values[k] = _grown(self.values[k], used, values)
                ends = np.cumsum(n) + used
                self.offsets[k] = _grown(self.offsets[k], self.count + 1, ends)
            self.count += len(new)
            self.runs[1] = self._merged(self.runs[1], (u[fresh], slot[fresh]))
            if 4 * len(self.runs[1][0]) > len(self.runs[0][0]):
                self.runs = [self._merged(*self.runs), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        return slot[each]

    @staticmethod
    def _merged(a, b):
        keys, slots = (np.concatenate(x) for x in zip(a, b))
        order = np.argsort(keys, kind="stable")
        return keys[order], slots[order]

    def rows(self, slots: np.ndarray, column: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(values of the slots one after another, number of values of each)."""
        off = self.offsets[column]
        n = off[slots + 1] - off[slots]
        if not len(slots):
            return np.zeros(0, np.int64), n
        return self.values[column][tk.ragged(off[slots], n)], n


def encoded_docs(cache: PieceCache, buf: np.ndarray, off: np.ndarray):
    """For each column of the cache (values, first): those of document d are
    values[first[d]:first[d+1]]."""
    bounds = cut(buf, off, cache.literals)
    slots = cache.look_up(buf, bounds) if len(bounds) > 1 else np.zeros(0, np.int64)
    doc = np.searchsorted(bounds[:-1], off)
    out = []
    for k in range(cache.n):
        values, n = cache.rows(slots, k)
        out.append((values, np.concatenate([[0], np.cumsum(n)])[doc]))
    return out
