"""Length-limited canonical Huffman codes over token ids: lengths, packing, table decoding.

A coded document starts on a byte and carries a checkpoint, the bit offset within the
document, for every ``EVERY`` ids. Stretches between checkpoints are independent, so they are
decoded side by side, one table look-up for each id.
"""

from __future__ import annotations

import numpy as np

from martlake.llm import textkit as tk

EVERY = 512


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code length of every id (0: not coded) by package merge; no length exceeds ``limit``."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, kinds = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        level = both[by]
        kinds.append(by < len(leaves))
    take, add = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for kind in reversed(kinds):
        n = int(kind[:take].sum())
        add[:n] += 1
        take = 2 * (take - n)
    lengths[order] = add
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    if len(order):
        size = lengths[order].astype(np.int64)
        most = int(size[-1])
        # left-aligned, the codes of the order are the running sums of 2**(most - length)
        ends = np.cumsum(np.int64(1) << (most - size))
        codes[order] = ((ends - (np.int64(1) << (most - size))) >> (most - size)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, length) for every bit pattern of the longest code's width, and that width."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    size = lengths[order].astype(np.int64)
    width = int(size[-1]) if len(size) else 1
    spans = np.int64(1) << (width - size)
    ids, lens = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    total = int(spans.sum())
    ids[:total], lens[:total] = np.repeat(order.astype(np.uint32), spans), np.repeat(size.astype(np.uint8), spans)
    return ids, lens, width


def pack(ids: np.ndarray, off: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Coded documents, ``ids[off[d]:off[d+1]]`` each: (bytes, byte offsets of the documents,
    checkpoints, offsets of the documents' checkpoints)."""
    n = np.diff(off)
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    bits = ends[off[1:]] - ends[off[:-1]]
    starts = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    at = ends[:-1] + np.repeat(starts[:-1] * 8 - ends[off[:-1]], n)
    window = codes[ids] << (np.uint64(64) - (at & 31).astype(np.uint64) - size.astype(np.uint64))
    word = at >> 5
    n_words = int(starts[-1] * 8 // 32 + 2)
    # codes don't overlap, so adding them up sets their bits; sums under 2**32 are exact
    out = np.bincount(word, (window >> np.uint64(32)).astype(np.float64), n_words)
    out += np.bincount(word + 1, (window & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    data = out.astype(np.uint64).astype(">u4").view(np.uint8)[:starts[-1]]
    per = (n + EVERY - 1) // EVERY
    marks = np.concatenate([[0], np.cumsum(per)])
    first = np.repeat(off[:-1], per) + tk.ragged(np.zeros(len(n), np.int64), per) * EVERY
    return data, starts, (at[first] - np.repeat(starts[:-1] * 8, per)).astype(np.uint32), marks


def unpack(data: np.ndarray, starts: np.ndarray, n: np.ndarray, checks: np.ndarray, table) -> np.ndarray:
    """The ids of all documents of ``pack``, one after another; ``n`` ids in each."""
    ids, lens, width = table
    per = (n + EVERY - 1) // EVERY
    at = checks.astype(np.int64) + np.repeat(starts[:-1] * 8, per)
    off = np.concatenate([[0], np.cumsum(n)])
    place = np.repeat(off[:-1], per) + tk.ragged(np.zeros(len(n), np.int64), per) * EVERY
    left = np.minimum(np.repeat(off[1:], per) - place, EVERY)
    by = np.argsort(-left, kind="stable")
    at, place, left = at[by], place[by], left[by]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # the 32 bits from every byte on
    look = (padded[:-3].astype(np.uint32) << 24) | (padded[1:-2].astype(np.uint32) << 16) \
        | (padded[2:-1].astype(np.uint32) << 8) | padded[3:]
    out = np.zeros(int(off[-1]), np.uint32)
    live = np.searchsorted(-left, -np.arange(EVERY), "left")  # stretches with more than k ids left
    for k in range(EVERY):
        m = int(live[k])
        if not m:
            break
        a = at[:m]
        pattern = (look[a >> 3] << (a & 7).astype(np.uint32)) >> np.uint32(32 - width)
        out[place[:m] + k] = ids[pattern]
        a += lens[pattern]
    return out
