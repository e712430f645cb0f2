"""Hashed word shingles of text columns, worked out on whole Arrow buffers."""

from __future__ import annotations

import numpy as np

from shelfwise.llm.common import WHITE, mix64

_SPACE = np.isin(np.arange(256), list(WHITE.encode()))
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
#: Bytes hashed at a time.
_CHUNK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, in order. Words are runs of bytes but ASCII white space."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    begins = inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1])))
    ends = inside & (edge[1:] | np.concatenate((~inside[1:], [True])))
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # as many words as fit a chunk, one at least
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + _CHUNK, "right")))
        lo, hi = starts[at], stops[to - 1]
        size = int(hi - lo)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * _powers(_BASE, size), out=sums[1:])
        s, e = starts[at:to] - lo, stops[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * _powers(_INVERSE, size)[s]
        at = to
    return mix64(out), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes (63 bits) of its runs of ``n`` words; a text of fewer words
    has one shingle of all its words, a text without words has none."""
    words, owner = word_hashes(data, offsets)
    texts = len(offsets) - 1
    have = np.bincount(owner, minlength=texts)
    first = np.concatenate(([0], np.cumsum(have)))
    step = np.uint64(0xD6E8FEB86659FD93)
    runs = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        runs = runs * step + words[k : len(words) - n + 1 + k]
    runs = mix64(runs) >> np.uint64(1)
    out = []
    for d in range(texts):
        a, b = first[d], first[d + 1]
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            h = np.uint64(0)
            for w in words[a:b]:
                h = np.uint64((int(h) * int(step) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix64(np.array([h ^ np.uint64(b - a)])) >> np.uint64(1))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set (as signed), 0 for an empty set."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    some = np.flatnonzero(size)
    starts = (np.cumsum(size) - size)[some]
    out = []
    for salt in (0x1234567, 0x89ABCDEF01):
        sums = np.zeros(len(sets), np.uint64)
        if len(some):
            sums[some] = np.add.reduceat(mix64(flat ^ np.uint64(salt)), starts)
        out.append(sums.view(np.int64))
    return out[0], out[1]


def common_counts(sets: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections of a block of sets of distinct values."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    out = np.zeros((n, n), np.float32)
    flat = np.concatenate(sets) if n else np.empty(0, np.uint64)
    _, back, seen = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = seen[back] > 1
    back, owner = back[shared], owner[shared]
    if len(back):
        number = np.cumsum(seen > 1) - 1
        col = number[back]
        order = np.argsort(col, kind="stable")
        col, owner = col[order], owner[order]
        for lo in range(0, int(col[-1]) + 1, width):
            a, b = np.searchsorted(col, [lo, lo + width])
            x = np.zeros((n, min(width, int(col[-1]) + 1 - lo)), np.float32)
            x[owner[a:b], col[a:b] - lo] = 1
            out += x @ x.T
    np.fill_diagonal(out, size)
    return out
