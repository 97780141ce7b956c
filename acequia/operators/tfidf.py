"""Vocabularies and TF-IDF vectors as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.text import content_words


def terms(df: DataFrame, id_column: str, text: str, stop_words: list[str]) -> DataFrame:
    """(id, term, n): content words of each document."""
    flat = df.where(F.col(text).isNotNull()).select(F.col(id_column).alias("id"), F.explode(content_words(F.col(text), stop_words)).alias("term"))
    return flat.groupBy("id", "term").agg(F.count("*").alias("n"))


def vocabulary(counted: DataFrame, min_df: int = 2, most: int = 5000) -> DataFrame:
    """(term, df, tf): terms of enough documents, the most frequent of them; ties by document frequency, then the later in the alphabet."""
    by = counted.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("tf")).where(F.col("df") >= min_df)
    return by.orderBy(F.desc("tf"), F.desc("df"), F.desc("term")).limit(most)


def vectors(counted: DataFrame, vocab: DataFrame, n_docs: int, digits: int = 6) -> DataFrame:
    """(id, term, weight): relative frequency times smoothed idf plus one, each document at length 1."""
    size = counted.groupBy("id").agg(F.sum("n").alias("size"))
    idf = vocab.select("term", (F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = counted.join(idf, "term").join(size, "id").select("id", "term", (F.col("n") / F.col("size") * F.col("idf")).alias("w"))
    length = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    return raw.join(length, "id").select("id", "term", F.round(F.col("w") / F.col("l"), digits).alias("weight"))


def top_terms(weights: DataFrame, clusters: DataFrame, k: int = 10) -> DataFrame:
    """(cluster, term, weight, rank): terms of the largest weight sums of each cluster."""
    by = weights.join(clusters, "id").groupBy("cluster", "term").agg(F.round(F.sum("weight"), 6).alias("weight"))
    return by.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("weight"), "term"))).where(F.col("rank") <= k)
