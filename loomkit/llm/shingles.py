"""Word-shingle sets of many texts at once, as 64-bit hashes in numpy.

A-Z are lower-cased, words are runs of anything but ``[\\x20\\x09-\\x0D]``, a text's
set holds its distinct 5-word shingles, or its whole sequence if it has fewer words.
"""

from __future__ import annotations

import numpy as np

from .common import blocks

WORDS = 5
BLOCK = 256 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240101)
_WEIGHT = _RNG.integers(1, 1 << 63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2**64, for i up to ``n``."""
    while len(_POWERS[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = _POWERS[k]
            _POWERS[k] = np.concatenate([p, p * np.uint64(pow(int(base), len(p), 1 << 64))])
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of values[k] * _BASE ** k over i <= k < j, modulo 2**64."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:len(values)], out=out[1:])
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray):
    """Yields (first row, sorted distinct shingle hashes of all the block's rows, their row offsets), block by block."""
    for lo, hi in blocks(np.diff(offsets), BLOCK):
        yield lo, *_block(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


def _block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = len(offsets) - 1
    solid = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    inner = offsets[1:-1]
    if len(start) and len(inner):  # a word that runs over the end of a text is two words
        cut = np.unique(inner)
        at = np.searchsorted(start, cut, "right") - 1
        ok = (at >= 0) & (start[at] < cut) & (cut < end[at])
        cut = cut[ok]
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    h = prefix_hashes(_LOWER[data])
    _, down = powers(len(data))
    words = mixed((h[end] - h[start]) * down[start] + (end - start).astype(np.uint64) * _WEIGHT[WORDS])
    first = np.searchsorted(start, offsets)  # first word of each row
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    full = len(words) - WORDS + 1
    out_rows, out = [], []
    if full > 0:
        long_enough = row[:full] == row[WORDS - 1:]
        s = sum(words[k:full + k] * _WEIGHT[k] for k in range(WORDS))
        out.append(s[long_enough])
        out_rows.append(row[:full][long_enough])
    few = np.flatnonzero((n > 0) & (n < WORDS))
    if len(few):
        s = n[few].astype(np.uint64) * _WEIGHT[WORDS]
        for k in range(WORDS - 1):
            has = n[few] > k
            s[has] += words[first[few[has]] + k] * _WEIGHT[k]
        out.append(s)
        out_rows.append(few)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    s, r = mixed(np.concatenate(out)), np.concatenate(out_rows)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    s, r = s[new], r[new]
    return s, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=rows))])
