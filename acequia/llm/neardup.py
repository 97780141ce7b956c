"""Problem 6: near-duplicate records with small edits.

b-bit MinHash. Each record is the multiset of its words; every word counts as
one, as in the overlap that is asked for. Bands of minima give candidates, so
a pair of overlap s is missed only if none of the bands agrees, with the
probability ``(1 - s ** ROWS) ** BANDS`` whatever its words are. Of each
minimum the low bit is kept; packed, the bits give a collision-corrected
estimate of the overlap by bit counts. They travel with the band keys, so
accidental meetings are discarded where they meet. What is left is compared
exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm import features
from acequia.llm.features import Multisets, by_row, common_words, likely_among, mix, signed
from acequia.llm.text import map_rows, not_blank
from acequia.operators.minhash import components
from acequia.session import materialize

#: Bands of minima, and minima by band. A pair of overlap .8 is missed with a probability of 6e-5, one of .85 with 3e-7. More rows
#: with more bands (10 and 100: 1e-5) let fewer unrelated records meet, at more keys a record.
BANDS, ROWS = 32, 6
#: Standard deviations of the estimate below the asked overlap at which a candidate is discarded (a probability of 3e-5 at that overlap).
DEVIATIONS = 4.0
#: Rows whose minima are taken at once, and elements of one row at once.
CHUNK, LONG = 512, 2048
#: Members from which on a band key is cut into blocks, and records from which hot keys are told.
HOT, TOLD = 8000, 20_000


def records(rows: DataFrame, id_column: str, text_columns: list[str]) -> DataFrame:
    """(id, text): text columns joined; rows with a null or blank one don't count."""
    there: Column = F.lit(True)
    for c in text_columns:
        there = there & not_blank(c)
    return rows.where(there & F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.concat_ws("\n", *text_columns).alias("text"))


class Permutations:
    """Hash functions of 32 bits whose minima are taken; a table of the different elements of some rows serves them all."""

    def __init__(self, number: int):
        rng = np.random.default_rng(20240101)
        self.odd, self.turn = (rng.integers(0, 2**31, number, dtype=np.uint32) * np.uint32(2) + np.uint32(1) for _ in range(2))

    def table(self, e: np.ndarray) -> np.ndarray:
        h = (e >> np.uint64(32)).astype(np.uint32)[:, None] * self.odd
        h ^= h >> np.uint32(15)
        h *= self.turn
        h ^= h >> np.uint32(16)
        return h

    def minima(self, e: np.ndarray, n: np.ndarray) -> np.ndarray:
        """By row, the minimum of each function over its n elements, rows lying one after another."""
        out = np.full((len(n), len(self.odd)), 0xFFFFFFFF, dtype=np.uint32)
        starts = np.cumsum(n) - n
        by_size = np.argsort(-n, kind="stable")
        by_size = by_size[: int((n > 0).sum())]
        for i in by_size[: int((n > LONG).sum())].tolist():
            for part in range(starts[i], starts[i] + n[i], LONG):
                np.minimum(out[i], self.table(e[part : min(part + LONG, starts[i] + n[i])]).min(axis=0), out=out[i])
        by_size = by_size[int((n > LONG).sum()) :]
        for first in range(0, len(by_size), CHUNK):  # rows of like size, the longest first: the k-th element of all that have one at a time
            rows = by_size[first : first + CHUNK]
            size = n[rows]
            inside = np.arange(size[0]) < size[:, None]
            places = (starts[rows][:, None] + np.arange(size[0]))[inside]
            kinds, at = np.unique(e[places], return_inverse=True)
            table = self.table(kinds)
            which = np.zeros(inside.shape, dtype=np.int64)
            which[inside] = at
            least = table[which[:, 0]]
            for k, rows_left in enumerate(inside.sum(axis=0).tolist()):
                if k:
                    np.minimum(least[:rows_left], table[which[:rows_left, k]], out=least[:rows_left])
            out[rows] = least
        return out


def signatures(texts: DataFrame, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """(id, c1, c2, n, bits, keys): class, number of words, packed low bits and band keys of each record that has a word.

    Records of one class have the same words equally often (128-bit hash).
    """
    functions = Permutations(bands * per_band)
    id_type = texts.schema["id"].dataType.simpleString()
    longs = -(-bands * per_band // 64)

    def sign(batch: dict[str, list]) -> dict[str, list]:
        sets = Multisets(batch["text"])
        _, e = sets.elements()
        n = sets.size
        c1, c2 = by_row(np.add, e, n), by_row(np.add, mix(e + np.uint64(0x51ED270B)), n)
        some = n > 0
        at = np.nonzero(some)[0].tolist()
        least = functions.minima(e, n)[some]
        low = np.zeros((len(at), longs * 64), dtype=np.uint8)
        low[:, : bands * per_band] = least & 1
        bits = np.packbits(low, axis=1).view(np.int64).ravel()
        keys = np.zeros((len(at), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
        for k in range(per_band):
            keys = mix(keys ^ least[:, k::per_band].astype(np.uint64))
        return {
            "id": [batch["id"][i] for i in at],
            "c1": signed(c1[some]),
            "c2": signed(c2[some]),
            "n": n[some].tolist(),
            "bits": features.lists(np.full(len(at), longs), pa.array(bits)),
            "keys": features.lists(np.full(len(at), bands), pa.array(keys.view(np.int64).ravel())),
        }

    return map_rows(texts, sign, f"id {id_type}, c1 bigint, c2 bigint, n int, bits array<bigint>, keys array<bigint>")


def estimate(unequal: Column, minima: int) -> Column:
    """Overlap from the number of unequal low bits: the share of equal ones, less that of bits equal by chance."""
    return 1.0 - 2.0 * unequal / F.lit(float(minima))


def least_estimate(similarity: float, minima: int) -> float:
    """Estimate that a pair of the similarity falls below hardly ever: DEVIATIONS standard deviations under it."""
    return similarity - 2 * DEVIATIONS * ((1 - similarity) * (1 + similarity) / 4 / minima) ** 0.5


def _unequal(a: list[Column], b: list[Column]) -> Column:
    out = F.lit(0)
    for x, y in zip(a, b):
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def hot_keys(signed_rows: DataFrame) -> DataFrame:
    """(key, blocks): band keys of so many classes that these are compared in several tasks, and into how many blocks each is cut.

    Told from TOLD records or so, taken by a hash of the id; the result of
    the join doesn't depend on it. Its rows are bounded, for each stands for
    16 of the records told from at least.
    """
    share = max(1, signed_rows.count() // TOLD)
    told = signed_rows.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).dropDuplicates(["c1", "c2"])
    keys = told.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    members = F.col("n") * share
    return keys.where((F.col("n") >= 16) & (members > HOT)).select("key", F.ceil(members / HOT).cast("int").alias("blocks"))


def candidate_pairs(firsts: DataFrame, hot: DataFrame, similarity: float, minima: int) -> DataFrame:
    """(a, b), a < b, of records (id, n, bits, keys): those that meet in a band and whose sizes and low bits allow the similarity.

    A hot key's members are dealt to blocks by id, and each two blocks are
    joined in a task of their own.
    """
    lead = range(-(-minima // 64))
    keyed = firsts.select("id", "n", *[F.col("bits")[i].alias(f"s{i}") for i in lead], F.explode("keys").alias("key"))
    if hot.limit(1).count():
        mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        cells = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(o, mine) * F.col("blocks") + F.greatest(o, mine)))
        # the block a row is of, so that a pair of one block isn't met again in the cells both go to
        dealt = keyed.join(hot, "key", "left").withColumn("mine", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(mine))
        keyed = dealt.withColumn("cell", F.explode(cells)).select("id", "n", *[f"s{i}" for i in lead], "key", "cell", "mine", F.coalesce("blocks", F.lit(1)).alias("blocks"))
        on = ["key", "cell"]
        once = F.least("mine_a", "mine_b") * F.col("blocks_a") + F.greatest("mine_a", "mine_b") == F.col("cell")
    else:
        on, once = ["key"], F.lit(True)
    a, b = (keyed.select(*on, *[F.col(c).alias(f"{c}_{side}") for c in keyed.columns if c not in on]) for side in "ab")
    apart = _unequal([F.col(f"s{i}_a") for i in lead], [F.col(f"s{i}_b") for i in lead])
    near = (
        (F.col("id_a") < F.col("id_b"))
        & (F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-6)
        & (estimate(apart, minima) >= least_estimate(similarity, minima))
    )
    # merged, for a hash table of one side would walk all members of a key for each row
    return a.join(b.hint("merge"), on).where(once & near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def near_classes(rows: DataFrame, id_column: str, text_columns: list[str], similarity: float = 0.8, bands: int = BANDS, per_band: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(links, members) of the records.

    members: (id, rep), each record with the least id of its class, a class
    being the records with the same words equally often. links: (a, b,
    overlap), a < b, each two classes, by their least ids, whose word overlap
    is at least ``similarity``. No partner is left out for being one of many.
    """
    minima = bands * per_band
    texts = records(rows, id_column, text_columns)
    signed_rows = materialize(signatures(texts, bands, per_band), "signatures")
    reps = signed_rows.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
    members = signed_rows.select("id", "c1", "c2").join(reps, ["c1", "c2"]).select("id", "rep")
    firsts = signed_rows.select("id", "n", "bits", "keys").join(reps.select(F.col("rep").alias("id")), "id", "left_semi")
    hot = materialize(hot_keys(signed_rows), "hot-keys")
    kept = materialize(candidate_pairs(firsts, hot, similarity, minima), "candidates")
    ids = kept.select(F.explode(F.array("a", "b")).alias("id"))
    needed = likely_among(texts, "id", ids)
    both = kept.join(needed.toDF("a", "text_a"), "a").join(needed.toDF("b", "text_b"), "b")

    def compare(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"a": [], "b": [], "overlap": []}
        for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            common, n, m, _ = common_words(x, y)
            if common >= similarity * (n + m - common) - 1e-9:
                out["a"].append(a)
                out["b"].append(b)
                out["overlap"].append(common / (n + m - common))
        return out

    id_type = texts.schema["id"].dataType.simpleString()
    return map_rows(both, compare, f"a {id_type}, b {id_type}, overlap double").distinct(), members.distinct()


def near_pairs(rows: DataFrame, id_column: str, text_columns: list[str], similarity: float = 0.8) -> DataFrame:
    """(id_a, id_b) with id_a < id_b: every pair of records whose word overlap is at least ``similarity``.

    Rows with a null or blank text, or a null id, are in no pair; nor are
    texts without a word. An id counts once however often its row is
    repeated. Texts are compared whole. Other columns are ignored; an empty
    table gives an empty result.
    """
    links, members = near_classes(rows, id_column, text_columns, similarity)
    members = materialize(members, "members")
    x, y = members.toDF("x", "a"), members.toDF("y", "b")
    across = links.join(x, "a").join(y, "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    within = x.join(members.toDF("y", "a"), "a").where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.where("id_a <> id_b").unionByName(within).distinct()


def near_groups(rows: DataFrame, id_column: str, text_columns: list[str], similarity: float = 0.8) -> DataFrame:
    """(id, rep, group_id, n_links): each record with its class, its group and the number of classes its own is linked to.

    Groups are connected components; group_id is the least id in each.
    """
    links, members = near_classes(rows, id_column, text_columns, similarity)
    links = materialize(links.select("a", "b"), "links")
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    placed = members.join(components(links).withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left")
    return placed.select("id", "rep", F.coalesce("group_id", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
