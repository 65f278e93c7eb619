"""Words and word windows of many texts as 64-bit hashes, in whole-array steps."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words remembered per worker; beyond it new words are hashed each time.
MEMO_WORDS = 200_000
_R1, _R2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word):
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS and len(word) <= 64:
            self[word] = h
        return h


_MEMO = _Words()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(r: np.uint64, n: int):
    got = _POWERS.get(int(r))
    if got is None or len(got[0]) < n:
        size = max(n, 1 << 16) * 5 // 4
        inverse = np.uint64(pow(int(r), -1, 1 << 64))
        both = []
        for x in (r, inverse):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        got = _POWERS[int(r)] = tuple(both)
    return got[0][:n], got[1][:n]


class Windows:
    """Hashes of any stretches of one array of element hashes."""

    def __init__(self, h: np.ndarray, second: bool = False):
        r = _R2 if second else _R1
        if second:
            h = mix(h + _R2)
        up, self.down = _powers(r, len(h) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _R2)

    def every(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` elements."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n] + np.uint64(size * int(_R2) % (1 << 64)))


def window_starts(count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the flat array at which a window of ``size`` elements of one
    document starts, and their documents."""
    from plantwise.llm.common import ranges

    n = np.maximum(count - size + 1, 0)
    first = np.cumsum(count) - count
    return ranges(first, n), np.repeat(np.arange(len(count)), n)


def selected(g: np.ndarray, starts: np.ndarray, w: int) -> np.ndarray:
    """For each start the place of the least of ``g[start:start + w]``, the
    rightmost of equals."""
    best, place = g[starts], starts.copy()
    for d in range(1, w):
        x = g[starts + d]
        take = x <= best
        best = np.where(take, x, best)
        place = np.where(take, starts + d, place)
    return place
