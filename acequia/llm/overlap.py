"""Problem 4: records that stand in two splits.

A weighted cosine join. A record's text is a vector of root word counts over
its length; a word overlap of s forces a cosine of 2s/(1+s) at least between
two of them. The words of a vector are ordered from rare to common, and only
those go into the inverted lists before which the rest of the vector, by its
norm or by the largest weights it can meet, could still reach that cosine.
Lists of the two splits are joined word by word, long ones in blocks; a pair passes if the product
at the word plus the product of the norms left on both sides can reach the
cosine of their lengths. Survivors get exact dot products and word overlaps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.llm.features import Multisets, bucket, by_row, common_words, frequencies, likely_among, lists, mix, signed
from acequia.llm.text import map_rows, not_blank, source_name
from acequia.session import materialize


#: Records with a word (or another of its bucket) from which on its list is cut into blocks, each joined in a task of its own.
HOT = 20_000


def _bits(e: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64 parities of a multiset: those of two differ in at most as many bits as the multisets in elements."""
    return by_row(np.bitwise_xor, np.uint64(1) << (e >> np.uint64(58)), n)


def vectors(rows: DataFrame, first: str, second: str, similarity: float) -> DataFrame:
    """(id, part, c1, c2, n, m, bits, bits2, lists): class, sizes, parities and indexed words of each record."""
    count, most, _ = frequencies(rows, [first], of_elements=False, weights=True)
    shared = rows.sparkSession.sparkContext.broadcast((count, most))
    id_type = rows.schema["id"].dataType.simpleString()
    least, hot = 2 * similarity / (1 + similarity), HOT

    def run(batch: dict[str, list]) -> dict[str, list]:
        count, most = shared.value
        one, two = Multisets(batch[first]), Multisets(batch[second])
        e, f = one.elements()[1], two.elements()[1]
        turn = np.uint64(0x51ED270B)
        c1 = by_row(np.add, e, one.size) + mix(by_row(np.add, f, two.size))
        c2 = by_row(np.add, mix(e + turn), one.size) + mix(by_row(np.add, mix(f + turn), two.size))
        b = bucket(one.hash)
        order = np.lexsort((one.hash, count[b], one.row))
        row, h, b = one.row[order], one.hash[order], b[order]
        squares = one.times[order] / one.size[row]
        ends = np.cumsum(one.kinds)
        starts = ends - one.kinds
        upto = np.cumsum(squares)
        before = upto - squares
        base = np.where(one.kinds > 0, before[np.minimum(starts, max(len(before) - 1, 0))] if len(before) else 0.0, 0.0)
        left = np.clip(1.0 - (before - base[row]), 0.0, 1.0)  # squared norm from this word on
        product = np.sqrt(squares) * most[b]
        behind = np.cumsum(product[::-1])[::-1] if len(product) else product
        tail = np.zeros(len(batch["id"]))
        inside = ends < len(product)
        tail[inside] = behind[ends[inside]]
        keep = (left >= (least - 1e-9) ** 2) & (behind - tail[row] >= least - 1e-9)
        rest = np.sqrt(np.clip(left - squares, 0.0, 1.0))
        weight = np.sqrt(squares)
        blocks = np.maximum(1, -(-count[b] // hot)).astype(np.int32)
        some = np.nonzero((one.size > 0) & (two.size > 0))[0]
        at = some.tolist()
        keep &= (two.size > 0)[row]
        kinds = np.bincount(row[keep], minlength=len(one.size))[some]
        indexed = pa.StructArray.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(weight[keep].astype(np.float32)), pa.array(rest[keep].astype(np.float32)), pa.array(blocks[keep])], ["word", "w", "rest", "blocks"])
        return {
            "id": [batch["id"][i] for i in at],
            "part": [batch["part"][i] for i in at],
            "c1": signed(c1[some]),
            "c2": signed(c2[some]),
            "n": one.size[some].tolist(),
            "m": two.size[some].tolist(),
            "bits": signed(_bits(e, one.size)[some]),
            "bits2": signed(_bits(f, two.size)[some]),
            "lists": lists(kinds, indexed),
        }

    schema = f"id {id_type}, part int, c1 bigint, c2 bigint, n int, m int, bits bigint, bits2 bigint, lists array<struct<word: bigint, w: float, rest: float, blocks: int>>"
    return map_rows(rows, run, schema)


def cross_split_pairs(
    rows: DataFrame,
    *,
    id_column: str = "pair_id",
    split_column: str = "split_name",
    text_columns: tuple[str, str] = ("text_es", "text_en"),
    one: tuple[str, ...] = ("train",),
    other: tuple[str, ...] = ("validation", "test"),
    similarity: float = 0.8,
) -> DataFrame:
    """(id_one, id_other, overlap, overlap2, cosine): each record of one split that also stands in the other.

    Both texts of the two records must have a word overlap of ``similarity``
    at least. Rows with a null id or split, or a null, blank or wordless text
    match nothing; repeated rows of an id count once; other columns are
    ignored; empty tables or splits give an empty result. Records with the
    same words are compared once, by the least id of their split, and
    expanded into pairs at the end.
    """
    first, second = text_columns
    part = F.when(F.col(split_column).isin(*one), F.lit(0)).when(F.col(split_column).isin(*other), F.lit(1))
    texts = rows.select(F.col(id_column).alias("id"), part.alias("part"), first, second).where(
        F.col("id").isNotNull() & F.col("part").isNotNull() & not_blank(first) & not_blank(second)
    )
    table = materialize(vectors(texts, first, second, similarity), "vectors")
    reps = table.groupBy("c1", "c2", "part").agg(F.min("id").alias("rep"))
    firsts = table.join(reps.select(F.col("rep").alias("id"), "part"), ["id", "part"], "left_semi").select("id", "part", "n", "m", "bits", "bits2", F.explode("lists").alias("l"))
    flat = firsts.select("id", "part", "n", "m", "bits", "bits2", "l.word", "l.w", "l.rest", "l.blocks")
    # a long list is dealt to cells on the one side, and goes to each of them on the other
    cell = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    a = flat.where("part = 0").select("word", cell.alias("cell_a"), *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "m", "bits", "bits2", "w", "rest")])
    b = flat.where("part = 1").select("word", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("cell_b"), *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "m", "bits", "bits2", "w", "rest")])
    near = F.lit(1.0 - 2 * similarity / (1 + similarity))
    apart = lambda x, n: F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) <= near * (F.col(f"{n}_a") + F.col(f"{n}_b")) + 1e-6
    alike = lambda n: F.least(f"{n}_a", f"{n}_b") >= F.lit(similarity) * F.greatest(f"{n}_a", f"{n}_b") - 1e-6
    both = F.col("n_a") + F.col("n_b")
    reach = F.col("w_a") * F.col("w_b") + F.col("rest_a") * F.col("rest_b")
    need = (1 - near) / 2 * both / F.sqrt(F.col("n_a").cast("double") * F.col("n_b"))
    condition = (F.col("word_a") == F.col("word_b")) & (F.col("cell_a") == F.col("cell_b")) & alike("n") & alike("m") & apart("bits", "n") & apart("bits2", "m") & (reach >= need - 1e-4)
    # merged, for a hash table of one side would walk a word's whole list for each row
    candidates = a.withColumnRenamed("word", "word_a").join(b.withColumnRenamed("word", "word_b").hint("merge"), condition).select("id_a", "id_b").distinct()
    candidates = materialize(candidates, "candidates")
    ids = candidates.select(F.explode(F.array("id_a", "id_b")).alias("id"))
    needed = likely_among(texts.drop("part"), "id", ids)
    pairs = candidates.join(needed.toDF("id_a", "x", "x2"), "id_a").join(needed.toDF("id_b", "y", "y2"), "id_b")

    def compare(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"id_a": [], "id_b": [], "overlap": [], "overlap2": [], "cosine": []}
        for i in range(len(batch["id_a"])):
            common, n, m, dot = common_words(batch["x"][i], batch["y"][i])
            if common < similarity * (n + m - common) - 1e-9:
                continue
            common2, n2, m2, _ = common_words(batch["x2"][i], batch["y2"][i])
            if common2 < similarity * (n2 + m2 - common2) - 1e-9:
                continue
            out["id_a"].append(batch["id_a"][i])
            out["id_b"].append(batch["id_b"][i])
            out["overlap"].append(common / (n + m - common))
            out["overlap2"].append(common2 / (n2 + m2 - common2))
            out["cosine"].append(dot / (n * m) ** 0.5)
        return out

    id_type = texts.schema["id"].dataType.simpleString()
    links = map_rows(pairs, compare, f"id_a {id_type}, id_b {id_type}, overlap double, overlap2 double, cosine double")
    members = materialize(table.select("id", "part", "c1", "c2").distinct().join(reps, ["c1", "c2", "part"]).select("id", "part", "rep"), "members")
    mine = members.where("part = 0").select(F.col("rep").alias("id_a"), F.col("id").alias("id_one"))
    theirs = members.where("part = 1").select(F.col("rep").alias("id_b"), F.col("id").alias("id_other"))
    return links.join(mine, "id_a").join(theirs, "id_b").select("id_one", "id_other", "overlap", "overlap2", "cosine").dropDuplicates(["id_one", "id_other"])


def overlap_report(rows: DataFrame, pairs: DataFrame, *, id_column: str = "pair_id", split_column: str = "split_name", source_column: str = "source_id") -> DataFrame:
    """(split, source, n_records, n_overlapping): evaluation records by split and source, and how many stand in the other split too."""
    found = pairs.select(F.col("id_other").alias(id_column)).distinct().withColumn("hit", F.lit(1))
    return (
        rows.select(id_column, split_column, source_name(source_column).alias("source"))
        .where(F.col(split_column).isin("validation", "test"))
        .join(found, id_column, "left")
        .groupBy(F.col(split_column).alias("split"), "source")
        .agg(F.count("*").alias("n_records"), F.count("hit").alias("n_overlapping"))
    )
