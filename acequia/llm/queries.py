"""Queries of the training-data problems, over the tables of TESTDATA.md."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.llm import budget, leaks, mixing, neardup, oracles, overlap, pairs, ranking, spam, splitting


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Vocabulary files of public tokenizers; a parameter of the queries that need one.
TOKENIZERS = os.environ.get("ACEQUIA_TOKENIZERS", "/opt/tokenizers")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defects(_read(spark, sf_dir, "responses"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.token_budget(_read(spark, sf_dir, "corpus_rows"), _read(spark, sf_dir, "resources")).drop("tokens_registered")


def p2_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = budget.subword_counts(_read(spark, sf_dir, "corpus_rows").drop("tokens"), f"{TOKENIZERS}/piece_bpe_32k.model")
    return budget.token_budget(rows, _read(spark, sf_dir, "resources"), F.col("n_subwords")).withColumnRenamed("n_tokens", "n_subwords")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ranking.ranking(ranking.judged(_read(spark, sf_dir, "preferences")))
    return placed.select(F.col("item").alias("model"), "rank_no")


def p3_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.residuals(ranking.judged(_read(spark, sf_dir, "preferences")))


def p3_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wins of each model beside those that the strengths lead to expect."""
    out = ranking.balance(ranking.judged(_read(spark, sf_dir, "preferences")))
    return out.select(F.col("item").alias("model"), "n", "wins", F.round("expected_wins", 1).alias("expected_wins"))


def p3_inconsistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.inconsistency(p3_residuals(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlap.cross_split_pairs(_read(spark, sf_dir, "parallel_biomedical"))
    return pairs.select(F.least("id_one", "id_other").alias("pair_id_a"), F.greatest("id_one", "id_other").alias("pair_id_b"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "parallel_biomedical")
    return overlap.overlap_report(rows, overlap.cross_split_pairs(rows))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.cut_kinds(splitting.split_oversized(_read(spark, sf_dir, "corpus_rows")))


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each oversized row, rows delivered again once."""
    pieces = splitting.split_oversized(_read(spark, sf_dir, "corpus_rows"))
    return pieces.dropDuplicates(["source_id", "id", "piece_no"])


def p5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each oversized row that its pieces hold, shared ones once, and whether all pieces are within the limit."""
    return p5_pieces(spark, sf_dir).groupBy("source_id", "id").agg(F.sum(F.col("n_tokens") - F.col("n_shared")).alias("n_tokens"), F.every(F.col("n_tokens") <= 512).alias("within"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neardup.near_pairs(_read(spark, sf_dir, "preferences"), "sample_id", ["prompt", "chosen"])
    return pairs.select(F.col("id_a").alias("sample_id_a"), F.col("id_b").alias("sample_id_b"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = neardup.near_groups(_read(spark, sf_dir, "preferences"), "sample_id", ["prompt", "chosen"])
    return groups.withColumnRenamed("id", "sample_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.remove_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "eval_items")).where("n_removed > 0")


def p7_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_clean(spark, sf_dir).select("doc_id", "n_removed")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "mix_targets")).select("source", "passes", "falls_short")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "mix_targets"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.keyword_pages(_read(spark, sf_dir, "documents")).where("is_spam").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items()) if name[0] == "p" and name[1:2].isdigit()
}

ORACLES: dict[str, str] = oracles.ORACLES
