"""Exact self-join of sets by Jaccard similarity.

The elements of a set are ordered from rare to common. Two sets of similarity
s share an element among the first n - ceil(s n) + 1 of each, so only those
are joined; a pair passes if the sizes, the places of the shared element and
128 parities of both sets still allow the overlap. Each test is a bound, so
no pair of the similarity is lost; what passes has to be compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.session import materialize

#: Buckets of the table of frequencies. Its size is the same for any corpus.
BUCKET_BITS = 18
#: Columns that ``columns`` gives for ``candidate_pairs``, beside the id.
SCHEMA = "n int, p1 bigint, p2 bigint, lead array<struct<e: bigint, at: int>>"


def bucket(e: np.ndarray) -> np.ndarray:
    return (e >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def columns(row: np.ndarray, e: np.ndarray, n: np.ndarray, count: np.ndarray, similarity: float) -> dict[str, pa.Array]:
    """Arrays of SCHEMA for sets of n elements each; row and e give the set and hash of every element, by set, none twice in one.

    ``count``: how common the elements of each bucket are. Any table gives a
    complete join, a true one a fast one.
    """
    order = np.lexsort((e, count[bucket(e)], row))
    row, e = row[order], e[order]
    at = np.arange(len(e)) - (np.cumsum(n) - n)[row]
    keep = at < (n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1)[row]
    offsets = np.zeros(len(n) + 1, dtype=np.int32)
    np.cumsum(np.bincount(row[keep], minlength=len(n)), out=offsets[1:])
    lead = pa.StructArray.from_arrays([pa.array(e[keep].view(np.int64)), pa.array(at[keep].astype(np.int32))], ["e", "at"])
    some = n > 0
    starts = (np.cumsum(n) - n)[some]
    bit = np.uint64(1) << ((e >> np.uint64(20)) & np.uint64(63))
    parities = []
    for k in (0, 1):
        p = np.zeros(len(n), dtype=np.uint64)
        if len(e):
            p[some] = np.bitwise_xor.reduceat(np.where((e >> np.uint64(26)) & np.uint64(1) == k, bit, np.uint64(0)), starts)
        parities.append(pa.array(p.view(np.int64)))
    return {"n": pa.array(n.astype(np.int32)), "p1": parities[0], "p2": parities[1], "lead": pa.ListArray.from_arrays(pa.array(offsets), lead)}


def candidate_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) with a < b, of sets (id, n, p1, p2, lead): every pair of at least the similarity, and some others."""
    flat = sets.select("id", "n", "p1", "p2", F.explode("lead").alias("l")).select("id", "n", "p1", "p2", "l.e", "l.at")
    # most rare elements stand alone: one sort finds the others, and only those are joined
    flat = flat.withColumn("among", F.count("*").over(Window.partitionBy("e"))).where("among > 1").drop("among")
    flat = materialize(flat, "leading")
    a, b = (flat.select("e", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "p1", "p2", "at")]) for side in "ab")
    both = F.col("n_a") + F.col("n_b")
    apart = F.bit_count(F.col("p1_a").bitwiseXOR(F.col("p1_b"))) + F.bit_count(F.col("p2_a").bitwiseXOR(F.col("p2_b")))
    possible = (
        (F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-6)
        & (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= F.lit(similarity / (1 + similarity)) * both - 1e-6)
        & (apart <= F.lit((1 - similarity) / (1 + similarity)) * both + 1e-6)
    )
    pairs = a.withColumnRenamed("e", "e_a").join(b.withColumnRenamed("e", "e_b").hint("merge"), (F.col("e_a") == F.col("e_b")) & (F.col("id_a") < F.col("id_b")) & possible)
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
