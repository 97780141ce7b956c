"""Chunks of documents: by distance between sentences, by tokens, by characters."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.text import sentences

_SPLIT = re.compile(r"(?<=[.?!])\s+")
_WORD = re.compile(r"\w+")
_TOKEN = re.compile(r"\w+|[^\w\s]")

# Amounts of the breakpoint rules.
AMOUNTS = {"percentile": 95.0, "standard_deviation": 3.0, "interquartile": 1.5, "gradient": 95.0}


def hashed_vectors(texts: list[str], size: int = 256) -> np.ndarray:
    """Word counts in hashed dimensions: what the chunker compares if no embedder is given."""
    import xxhash

    out = np.zeros((len(texts), size))
    for i, t in enumerate(texts):
        for w in _WORD.findall(t.lower()):
            out[i, xxhash.xxh32_intdigest(w) % size] += 1
    return out


def tokens_of(text: str) -> int:
    return len(_TOKEN.findall(text))


def neighbour_distances(parts: list[str], embed: Callable[[list[str]], np.ndarray], buffer: int = 1) -> np.ndarray:
    """1 - cosine of each sentence with its neighbours to the next one with its; zero vectors count as orthogonal."""
    around = [" ".join(parts[max(0, i - buffer) : i + buffer + 1]) for i in range(len(parts))]
    v = np.asarray(embed(around), dtype=float)
    n = np.linalg.norm(v, axis=1)
    length = n[:-1] * n[1:]
    dots = (v[:-1] * v[1:]).sum(1)
    return 1 - np.divide(dots, length, out=np.zeros(len(dots)), where=length > 0)


def breakpoint(distances: np.ndarray, rule: str, amount: float | None = None, chunks: int | None = None) -> tuple[float, np.ndarray]:
    """Threshold, and the values to hold against it.

    ``chunks`` takes the place of a rule: a percentile in proportion to the
    wanted number of chunks among the sentences.
    """
    if chunks is not None:
        most = float(len(distances))
        wanted = min(max(float(chunks), 1.0), max(most, 1.0))
        p = 100.0 if most <= 1 else 100.0 * (most - wanted) / (most - 1)
        return float(np.percentile(distances, min(max(p, 0.0), 100.0))), distances
    amount = AMOUNTS[rule] if amount is None else amount
    if rule == "percentile":
        return float(np.percentile(distances, amount)), distances
    if rule == "standard_deviation":
        return float(distances.mean() + amount * distances.std()), distances
    if rule == "interquartile":
        low, high = np.percentile(distances, [25, 75])
        return float(distances.mean() + amount * (high - low)), distances
    if rule == "gradient":
        slope = np.gradient(distances) if len(distances) > 1 else distances
        return float(np.percentile(slope, amount)), slope
    raise ValueError(f"unknown rule {rule}")


def pack(parts: list[str], most: int, slack: int) -> list[str]:
    """Sentences into chunks of ``most`` tokens, one more being let in up to the slack; longer ones are cut between words."""
    out: list[str] = []
    now: list[str] = []
    size = 0
    for part in parts:
        n = tokens_of(part)
        if n > most + slack:
            if now:
                out.append(" ".join(now))
            now, size = [], 0
            out += pack_words(part, most + slack)
        elif size + n <= most or now and size + n <= most + slack:
            now.append(part)
            size += n
        else:
            if now:
                out.append(" ".join(now))
            now, size = [part], n
    return out + ([" ".join(now)] if now else [])


def pack_words(sentence: str, most: int) -> list[str]:
    out: list[str] = []
    now: list[str] = []
    size = 0
    for word in sentence.split():
        n = tokens_of(word)
        if now and size + n > most:
            out.append(" ".join(now))
            now, size = [], 0
        now.append(word)
        size += n
    return out + ([" ".join(now)] if now else [])


def halve(parts: list[str], most: int, slack: int) -> list[str]:
    """A group within the slack in two: the first cut with both parts within ``most``, else the one that exceeds it least."""
    sizes = np.cumsum([tokens_of(p) for p in parts])
    best: tuple[int, int] | None = None
    for i in range(1, len(parts)):
        a, b = int(sizes[i - 1]), int(sizes[-1] - sizes[i - 1])
        if a <= most and b <= most:
            best = (0, i)
            break
        over = max(0, a - most) + max(0, b - most)
        if a <= most + slack and b <= most + slack and (best is None or over < best[0]):
            best = (over, i)
    if best is None:
        return pack(parts, most, slack) if len(parts) > 1 else [" ".join(parts)]
    return [" ".join(parts[: best[1]]), " ".join(parts[best[1] :])]


def balance(chunks: list[str], most: int, slack: int, spread: float = 0.2) -> list[str]:
    """Chunks well below the mean joined with the next, where sizes vary by more than ``spread``."""
    sizes = np.array([tokens_of(c) for c in chunks], dtype=float)
    if len(chunks) < 2 or sizes.mean() == 0 or sizes.std() / sizes.mean() <= spread:
        return chunks
    out: list[str] = []
    i = 0
    while i < len(chunks):
        joined = " ".join(chunks[i : i + 2])
        if i + 1 < len(chunks) and sizes[i] < sizes.mean() * (1 - spread) and tokens_of(joined) <= most + slack:
            out.append(joined)
            i += 2
        else:
            out.append(chunks[i])
            i += 1
    return out


def chunk_text(text: str, *, rule: str = "percentile", amount: float | None = None, chunks: int | None = None, most: int = 512, slack: int = 128, buffer: int = 1, even: bool = True, embed: Callable[[list[str]], np.ndarray] = hashed_vectors) -> list[str]:
    """Chunks of one text: split where the distance of neighbouring sentences passes the breakpoint, then fitted to the token limits."""
    parts = [p.strip() for p in _SPLIT.split(text) if p.strip()]
    if not parts:
        return []
    groups: list[list[str]] = [[]]
    if len(parts) > 2:
        at, held = breakpoint(neighbour_distances(parts, embed, buffer), rule, amount, chunks)
        for i, p in enumerate(parts):
            groups[-1].append(p)
            if i < len(held) and held[i] > at:
                groups.append([])
    else:
        groups[-1] = parts
    out: list[str] = []
    for group in groups:
        n = sum(map(tokens_of, group))
        if not group:
            continue
        if n <= most:
            out.append(" ".join(group))
        elif n <= most + slack:
            out += halve(group, most, slack)
        else:
            out += pack(group, most, slack)
    return balance(out, most, slack) if even else out


def semantic_chunks(df: DataFrame, source: str, id_column: str, text: str, *, least: int = 1, most: int = 512, slack: int = 128, **options: object) -> DataFrame:
    """(source_id, id_document, n_chunk, chunk, tokens, valid): chunks of each document in order.

    A document is chunked by itself in one task; null and blank texts give no chunk.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for s, i, t in zip(f["s"], f["i"], f["t"]):
                for n, c in enumerate(chunk_text(t, most=most, slack=slack, **options)):
                    k = tokens_of(c)
                    rows.append((s, i, n, c, k, least <= k <= most + slack))
            yield pd.DataFrame(rows, columns=["source_id", "id_document", "n_chunk", "chunk", "tokens", "valid"])

    there = df.where(F.trim(text) != "").select(F.col(source).cast("string").alias("s"), F.col(id_column).cast("string").alias("i"), F.col(text).alias("t"))
    return there.mapInPandas(run, "source_id string, id_document string, n_chunk int, chunk string, tokens int, valid boolean")


def fixed_chunks(df: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """(id, chunk_no, chunk): windows of ``size`` characters, one after another."""
    n = F.ceil(F.length(text) / size).cast("int")
    return df.where(F.length(text) > 0).select(F.col(id_column).alias("id"), F.col(text).alias("t"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no")).select("id", "chunk_no", F.substring("t", F.col("chunk_no") * size + 1, F.lit(size)).alias("chunk"))


def sentence_context(df: DataFrame, id_column: str, text: str, buffer: int = 1) -> DataFrame:
    """(id, n, sentence, context): each sentence with those around it."""
    parts = sentences(F.col(text))
    flat = df.where(F.col(text).isNotNull()).select(F.col(id_column).alias("id"), F.posexplode(parts).alias("n", "sentence"))
    w = Window.partitionBy("id").orderBy("n").rowsBetween(-buffer, buffer)  # sentences of one document
    return flat.withColumn("context", F.concat_ws(" ", F.collect_list("sentence").over(w)))
