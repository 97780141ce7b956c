"""Multisets of words as arrays of hashes, and bounded tables of how common each is."""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.text import fold, map_rows, words

#: Buckets of the table of frequencies. Its size is the same for any corpus.
BUCKET_BITS = 18
_KEEP = 400_000


class _Hashes(dict):
    """Hashes of words, worked out once and remembered, up to _KEEP of them."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KEEP:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def _hash(word: str) -> int:
    return _hashes[word]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Code points that a table folds; texts with others, or with letters whose lower case depends on their neighbours, are folded as strings.
_TABLE = 0x3000
#: Characters hashed at once.
_PART = 1 << 20
_STEP = 0x9E3779B97F4A7C15 | 5


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: a random number that stands for its folded form; 0 for what is no part of a word, 1 a part, 2 a mark that counts for nothing, 3 not to be told by the table."""
    kind, stands = np.zeros(_TABLE + 1, dtype=np.uint8), np.zeros(_TABLE + 1, dtype=np.uint64)
    for c in range(_TABLE):
        x = chr(c)
        plain = fold(x)
        if len(plain) == 1 and plain.isalnum():
            kind[c], stands[c] = 1, ord(plain)
        elif not plain and unicodedata.category(x) == "Mn":
            kind[c] = 2
        elif plain and any(y.isalnum() for y in plain):
            kind[c] = 3
    kind[0x3A3] = kind[_TABLE] = 3
    return kind, mix(stands + np.uint64(0x2545F4914F6CDD1D))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, text after text; words by text): as ``words`` finds them, but over many texts at once.

    A word's hash is a polynomial of the numbers that stand for its folded
    characters, taken from sums along the whole run of texts.
    """
    hashes: list[np.ndarray] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    first = 0
    while first < len(texts):
        last = size = 0
        part: list[str] = []
        while first + last < len(texts) and (not part or size < _PART):
            part.append(texts[first + last] or "")
            size += len(part[-1])
            last += 1
        h, n = _word_hashes(part)
        hashes.append(h)
        sizes[first : first + last] = n
        first += last
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), sizes


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    kinds, stands = KINDS, STANDS
    code = _codes(texts)
    kind = kinds[np.minimum(code, _TABLE)]
    folded = bool((kind == 3).any())
    if folded:
        odd = np.unique(np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.nonzero(kind == 3)[0], side="right"))
        texts = list(texts)
        for i in odd.tolist():
            texts[i] = "".join(c if c.isalnum() else " " for c in fold(texts[i]))
        code = _codes(texts)
        kind = kinds[np.minimum(code, _TABLE)]
        kind[kind == 3] = 1  # folded by now
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    if (kind == 2).any():
        stay = kind != 2
        ends = np.cumsum(stay)[np.minimum(ends, len(stay) - 1)] - (ends < len(stay))
        code, kind = code[stay], kind[stay]
    inside = np.zeros(len(code) + 2, dtype=np.int8)
    inside[1:-1] = kind == 1
    turn = np.diff(inside)
    begin, end = np.nonzero(turn == 1)[0], np.nonzero(turn == -1)[0]
    number = stands[np.minimum(code, _TABLE)]
    if folded:  # what the table doesn't know stands for itself
        same = kinds[np.minimum(code, _TABLE)] == 3
        number[same] = mix(code[same].astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    power, inverse = _powers(len(code))
    run = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum(number * power[: len(code)], out=run[1:])
    h = mix((run[end] - run[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return h, np.diff(np.searchsorted(begin, ends), prepend=0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of _STEP and of its inverse, modulo 2**64."""
    if len(_known[0]) < n:
        for k, step in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            _known[k] = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=np.uint64), np.full(max(n, _PART) - 1, step, dtype=np.uint64)]))
    return _known[0], _known[1]


_known = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
KINDS, STANDS = _tables()


def hashed_runs(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``width`` words of the texts."""
    h, sizes = word_hashes(texts)
    count = max(0, len(h) - width + 1)
    power, inverse = _powers(len(h) + 1)
    run = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * power[: len(h)], out=run[1:])
    out = mix((run[width:] - run[:count]) * inverse[:count]) if count else np.zeros(0, dtype=np.uint64)
    row = np.repeat(np.arange(len(texts)), sizes)[:count]
    inside = np.arange(count) + width <= np.cumsum(sizes)[row] if count else np.zeros(0, dtype=bool)
    return out[inside], row[inside]


class Multisets:
    """Words of a list of texts: by text, each different word's hash and how often it occurs."""

    def __init__(self, texts: list[str | None]):
        h, sizes = word_hashes(texts)
        row = np.repeat(np.arange(len(texts)), sizes)
        # equal words of a row side by side: rows in the upper bits, most of the hash in the lower
        order = np.argsort((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
        h, row = h[order], row[order]
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        starts = np.nonzero(first)[0]
        self.hash, self.row = h[starts], row[starts]
        self.times = np.diff(np.append(starts, len(h)))
        self.kinds = np.bincount(self.row, minlength=len(texts))
        self.size = sizes

    def elements(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of each occurrence: the k-th of a word is an element of its own, so overlaps are those of sets."""
        row = np.repeat(self.row, self.times)
        last = np.cumsum(self.times)
        k = np.arange(last[-1] if len(last) else 0) - np.repeat(last - self.times, self.times)
        return row, mix(np.repeat(self.hash, self.times) + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def by_row(ufunc: np.ufunc, values: np.ndarray, counts: np.ndarray, empty: int = 0) -> np.ndarray:
    """ufunc over the values of each row, rows lying one after another."""
    out = np.full(len(counts), empty, dtype=values.dtype)
    some = counts > 0
    if len(values):
        starts = np.cumsum(counts) - counts
        out[some] = ufunc.reduceat(values, starts[some])
    return out


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list array of values lying one after another."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def frequencies(rows: DataFrame, columns: list[str], of_elements: bool, weights: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows, largest weight) by bucket of word or element, and the number of rows, over all rows.

    Each task adds up a table of fixed size, the tables are added in the
    cluster, and what comes to the driver is one table of 2**BUCKET_BITS
    numbers however large the corpus. Where words share a bucket, their
    counts add up; results that only order words by it stay exact.
    """
    size = 1 << BUCKET_BITS

    def run(batch: dict[str, list]) -> dict[str, list]:
        n = np.zeros(size, dtype=np.int64)
        most = np.zeros(size)
        for c in columns:
            sets = Multisets(batch[c])
            if of_elements:
                row, h = sets.elements()
            else:
                row, h = sets.row, sets.hash
            b = bucket(h)
            n += np.bincount(b, minlength=size)
            if weights and len(b):
                np.maximum.at(most, b, np.sqrt(sets.times / sets.size[row]))
        some = np.nonzero(n)[0]
        return {"b": [*some.tolist(), -1], "n": [*n[some].tolist(), len(batch[columns[0]])], "w": [*most[some].tolist(), 0.0]}

    table = map_rows(rows.select(*columns), run, "b int, n bigint, w double").groupBy("b").agg(F.sum("n").alias("n"), F.max("w").alias("w"))
    got = table.toArrow()
    b, counts, weight = (got[c].to_numpy() for c in ("b", "n", "w"))
    n, w = np.zeros(size, dtype=np.int64), np.zeros(size)
    n[b[b >= 0]], w[b[b >= 0]] = counts[b >= 0], weight[b >= 0]
    total = int(counts[b < 0].sum())
    return n, w, total


def common_words(a: str, b: str) -> tuple[int, int, int, float]:
    """(words in common, words of a, words of b, dot product of root counts) of two texts."""
    x, y = Counter(words(a)), Counter(words(b))
    if len(x) > len(y):
        x, y = y, x
    common, dot = 0, 0.0
    for w, n in x.items():
        m = y.get(w)
        if m:
            common += n if n < m else m
            dot += (n * m) ** 0.5
    return common, sum(x.values()), sum(y.values()), dot


#: Bits of a map of ids, as a power of 2, at most: 8 MB.
ID_BITS = 26


def likely_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among ``wanted`` (one column), by a bitmap of 16 bits or more for each.

    Takes out most others before their texts go through a shuffle; never one
    that is wanted. Beyond 2**ID_BITS bits the map lets more through. It is
    put together in the cluster, 64 bits a row.
    """
    bits = min(ID_BITS, max(16, (16 * wanted.count()).bit_length()))
    spot: Column = F.pmod(F.xxhash64(F.col(wanted.columns[0]).cast("string")), F.lit(1 << bits))
    words = wanted.select(spot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(table.tobytes())

    @F.pandas_udf("boolean")
    def inside(s):  # noqa: ANN001, ANN202
        import pandas as pd

        known = np.frombuffer(shared.value, dtype=np.uint64)
        at = s.to_numpy(dtype=np.int64)
        return pd.Series((known[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return rows.where(inside(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << bits))))
