"""Simple-8b word-aligned integer coding in numpy.

A 64-bit word holds a 4-bit selector and as many equally wide values as its 60
data bits take.  Selector 15 is an escape: it marks a value of more than 60
bits, which follows in a raw word of its own.  Values are coded in blocks of a
fixed count (the last may be shorter) and every block starts a new word, so all
blocks are packed, and all words unpacked, in whole-array steps, and a reader
can start at any block.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: selector -> (values in a word, bits of each).
LAYOUT = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
BLOCK = 256
#: Bits that each value under 2^16 needs.
_SHORT = np.maximum(np.frexp(np.arange(1 << 16))[1], 1).astype(np.uint8)


def _widths(v: np.ndarray) -> np.ndarray:
    """Bits that each value needs (1 at least)."""
    most = int(v.max()) if len(v) else 0
    if most < 1 << 16:
        return _SHORT[v.astype(np.uint16)]
    if most < 1 << 53:  # exact as doubles
        return np.maximum(np.frexp(v.astype(np.float64))[1], 1).astype(np.uint8)
    w = np.ones(len(v), np.uint8)
    for s in (32, 16, 8, 4, 2, 1):
        high = v >> np.uint64(s)
        w += (high > 0).astype(np.uint8) * np.uint8(s)
        v = np.where(high > 0, high, v)
    return w


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block and their number at the end)."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    n_blocks = -(-n // block)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    # Selector for a word that starts at each place: the densest whose values all fit.
    reach = np.full(n_blocks * block, 255, np.uint8)  # widest of the next `have` values; no word goes past the last
    reach[:n] = _widths(v)
    sel = np.full(len(reach), ESCAPE, np.uint8)
    by_block, fits = sel.reshape(n_blocks, block), reach.reshape(n_blocks, block)
    have = 1
    for s in range(len(LAYOUT) - 1, -1, -1):
        count, width = LAYOUT[s]
        if count > block:
            break
        while have < count:
            step = min(have, count - have)
            np.maximum(reach[:-step], reach[step:], out=reach[:-step])
            have += step
        within = slice(0, block - count + 1)
        np.copyto(by_block[:, within], s, where=fits[:, within] <= width)
    # All blocks advance together, a word a step.
    count = np.array([c for c, _ in LAYOUT] + [0, 1], np.int64)
    at = np.arange(n_blocks, dtype=np.int64) * block
    end = np.minimum(at + block, n)
    live, heads = np.arange(n_blocks), np.zeros(n, bool)
    while len(live):
        heads[at[live]] = True
        at[live] += count[sel[at[live]]]
        live = live[at[live] < end[live]]
    place = np.flatnonzero(heads)
    kind = sel[place]
    width = 1 + (kind == ESCAPE)
    first = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    for s, (c, w) in enumerate(LAYOUT):
        k = np.flatnonzero(kind == s)
        if len(k):
            word = np.full(len(k), s << 60, np.uint64)
            for j in range(c):
                word |= v[place[k] + j] << np.uint64(j * w)
            words[first[k]] = word
    k = np.flatnonzero(kind == ESCAPE)
    words[first[k]] = np.uint64(ESCAPE << 60)
    words[first[k] + 1] = v[place[k]]
    per_block = np.bincount(place // block, weights=width, minlength=n_blocks).astype(np.uint64)
    return words, np.concatenate([np.zeros(1, np.uint64), np.cumsum(per_block, dtype=np.uint64)])


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """All ``n`` values of consecutive blocks."""
    kind = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(kind == ESCAPE):  # rare; an escaped raw word may look like an escape
        if not raw[i]:
            raw[i + 1] = True
    heads = np.flatnonzero(~raw)
    kind = kind[heads]
    count = np.array([c for c, _ in LAYOUT] + [0, 1], np.int64)[kind]
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s, (c, w) in enumerate(LAYOUT):
        k = np.flatnonzero(kind == s)
        if len(k):
            word, mask = words[heads[k]], np.uint64((1 << w) - 1)
            for j in range(c):
                out[first[k] + j] = (word >> np.uint64(j * w)) & mask
    k = np.flatnonzero(kind == ESCAPE)
    out[first[k]] = words[heads[k] + 1]
    if len(out) != n:
        raise ValueError(f"{len(out)} values instead of {n}")
    return out
