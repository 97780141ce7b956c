"""Pairs of texts that are alike by difflib's ratio, in blocks of texts that lie in one place.

Candidates share a MinHash band. Most meet by accident, so each is held
against bounds before it is compared. With M matching characters of S in both
texts, ratio 2M / S, the texts have at most S - 2M characters that aren't
common, and at most 5 (S - 2M) runs of three characters: M characters in k
blocks hold M - 2k runs or more, and k is S - 2M + 1 at most. What is counted
in buckets, modulo 256 or 16, differs by no more than that; and the longest common subsequence has M characters or more. So no candidate
of the ratio is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np

#: Buckets of the counts of characters, and of those of runs of three.
CHARS, RUNS = 64, 2048
#: Candidates that are held against the bounds at once.
CHUNK = 50_000


def sketch(texts: Iterator[str], number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its length, counts of its characters modulo 256 and of its runs of three modulo 16, two of these a byte."""
    size, chars, runs = np.zeros(number, np.int64), np.zeros((number, CHARS), np.uint8), np.zeros((number, RUNS // 2), np.uint8)
    for i, t in enumerate(texts):
        x = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size[i] = len(x)
        chars[i] = np.bincount(x & np.uint32(CHARS - 1), minlength=CHARS).astype(np.uint8)
        if len(x) > 2:
            e = ((x[:-2] * np.uint32(0x9E3779B1) + x[1:-1]) * np.uint32(0x85EBCA6B) + x[2:]) * np.uint32(0xC2B2AE35)
            n = (np.bincount(e >> np.uint32(32 - RUNS.bit_length() + 1), minlength=RUNS) & 15).astype(np.uint8)
            runs[i] = n[::2] | n[1::2] << 4
    return size, chars, runs


def meetings(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of every two equal keys, some CHUNK at once."""
    order = np.argsort(keys, kind="stable")
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[order[1:]] != keys[order[:-1]]
    starts = np.flatnonzero(first)
    ends = np.repeat(np.append(starts[1:], len(keys)), np.diff(np.append(starts, len(keys))))
    later = ends - np.arange(len(keys)) - 1
    some = np.flatnonzero(later)
    cuts = np.cumsum(later[some])
    at = 0
    while at < len(some):
        to = max(at + 1, int(np.searchsorted(cuts, (cuts[at - 1] if at else 0) + CHUNK, "right")))
        n = later[some[at:to]]
        x = np.repeat(some[at:to], n)
        yield order[x], order[x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)]
        at = to


def _apart(n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of rows of n, the least sum of differences of counts that are known modulo 16, two a byte."""
    out = np.zeros(len(a), np.int64)
    for i in range(0, len(a), 256):  # few at once, which stay in the cache
        x, y = n[a[i : i + 256]], n[b[i : i + 256]]
        for d in ((x - y) & 15, ((x >> 4) - (y >> 4)) & 15):
            out[i : i + 256] += np.minimum(d, 16 - d).sum(axis=1, dtype=np.uint16)
    return out


def possible(a: np.ndarray, b: np.ndarray, size: np.ndarray, chars: np.ndarray, runs: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (a, b) whose sketches allow the ratio."""
    for differ, times in (
        (lambda a, b: np.abs(size[a] - size[b]), 1),
        (lambda a, b: np.abs((chars[a] - chars[b]).view(np.int8)).view(np.uint8).sum(axis=1, dtype=np.int64), 1),
        # a text of fewer than three characters has no run, not less than none
        (lambda a, b: _apart(runs, a, b) - 4, 5),
    ):
        keep = differ(a, b) <= times * (1 - ratio) * (size[a] + size[b]) + 1e-6
        a, b = a[keep], b[keep]
    return a, b


def candidates(keys: np.ndarray, block: np.ndarray, texts: Iterator[str], ratio: float) -> np.ndarray:
    """(2, n) places of the texts that share a key of a band and whose sketches allow the ratio, each pair once.

    keys: by text and band. If there are texts of two blocks, only pairs
    across them.
    """
    size, chars, runs = sketch(texts, len(keys))
    across = len(block) > 0 and block.min() != block.max()
    found = [np.zeros(0, np.int64)]
    for band in range(keys.shape[1]):
        for a, b in meetings(keys[:, band]):
            if across:
                other = block[a] != block[b]
                a, b = a[other], b[other]
            a, b = possible(a, b, size, chars, runs, ratio)
            found.append(np.minimum(a, b) * len(keys) + np.maximum(a, b))
    pairs = np.unique(np.concatenate(found))
    return np.stack(np.divmod(pairs, max(1, len(keys))))


def common(x: str, y: str) -> int:
    """Length of the longest common subsequence, a bit for each character of x."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    v = full = (1 << len(x)) - 1
    for c in y:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(x) - v.bit_count()


def alike(x: str, y: str, ratio: float) -> float:
    """difflib's ratio of two texts, or 0 where it is less than ``ratio`` by a bound."""
    if 2 * common(x, y) < ratio * (len(x) + len(y)) - 1e-6:
        return 0.0
    m = SequenceMatcher(None, x, y, autojunk=False)
    return m.ratio() if m.real_quick_ratio() >= ratio and m.quick_ratio() >= ratio else 0.0
