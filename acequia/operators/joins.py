"""Joins of corpora with mappings, metadata, votes and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.text import hash_number

from acequia.operators.dedup import keep_first


def map_sources(df: DataFrame, mapping: DataFrame, old: str = "original_dataset", new: str = "mapped_dataset", column: str = "source_id") -> DataFrame:
    """The source's mapped name where there is one; a source mapped twice takes the first name in order."""
    once = mapping.groupBy(F.col(old).alias("__old")).agg(F.min(new).alias("__new"))
    return df.join(once, F.col(column) == F.col("__old"), "left").select(*[F.coalesce("__new", column).alias(column) if c == column else F.col(c) for c in df.columns])


def enrich(corpus: DataFrame, dataset: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Corpus rows that the dataset has, with columns of the dataset; rows with a null text are left out."""
    side = dataset.select(*keys, *carry)
    return corpus.where(F.col("text").isNotNull()).join(side, keys)


def two_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str = "left") -> DataFrame:
    """Equi-join on several keys of different names."""
    on = None
    for a, b in pairs:
        test = left[a] == right[b]
        on = test if on is None else on & test
    return left.join(right, on, how)


def with_counts(df: DataFrame, counts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Counts of each row's key, 0 where there are none."""
    return df.join(counts.select(key, *columns), key, "left").fillna(0, columns)


def retrieval_rows(results: DataFrame, references: DataFrame, contexts: DataFrame) -> DataFrame:
    """Results with reference and context of their query, each query's first."""
    refs = keep_first(references, ["id_query"], ["id_passage", "reference"])
    ctx = keep_first(contexts, ["id_query"], ["reference_contexts"])
    return results.join(refs, "id_query", "left").join(ctx, "id_query", "left")


def answered_by_both(a: DataFrame, b: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, value_a, value_b) of the keys in both, each side's last row by key."""
    fields = [*[c for c in order if c != value], value]
    last = lambda df, name: df.groupBy(key).agg(F.max(F.struct(*fields)).alias("r")).select(key, F.col(f"r.{value}").alias(name))
    return last(a, f"{value}_a").join(last(b, f"{value}_b"), key)


def distractors(queries: DataFrame, passages: DataFrame, id_query: str, id_relevant: str, id_passage: str, n: int = 100, seed: int = 42) -> DataFrame:
    """(id_query, id_passage, label): each query's relevant passage and n others of its own drawing.

    The others are drawn by bucket: a query takes the n passages that follow
    a point of its own on a circle of hashed passages, so no query is held
    against all of them.
    """
    circle = passages.select(F.col(id_passage).alias("p")).distinct().withColumn("h", hash_number(str(seed), F.col("p")))
    total = circle.count()
    buckets = max(1, total // max(1, 2 * n))
    circle = circle.withColumn("b", F.pmod("h", F.lit(buckets)))
    asked = queries.select(F.col(id_query).alias("q"), F.col(id_relevant).alias("rel")).withColumn("at", hash_number(str(seed + 1), F.col("q")))
    reach = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(min(2, buckets - 1))), lambda i: F.pmod(F.col("at") + i, F.lit(buckets)))))
    near = asked.withColumn("b", reach).join(circle, "b").where("p <> rel")
    order = Window.partitionBy("q").orderBy(hash_number(str(seed), F.col("q"), F.col("p")), "p")
    others = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).select("q", "p", F.lit(0).alias("label"))
    return asked.select("q", F.col("rel").alias("p"), F.lit(1).alias("label")).unionByName(others).toDF(id_query, id_passage, "label")
