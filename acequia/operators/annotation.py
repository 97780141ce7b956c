"""Labels by several annotators or models, and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_value_pivot(df: DataFrame, keys: list[str], model: str, value: str, order: str, models: list[str]) -> DataFrame:
    """One column by model with its last value that isn't null; null for a model without one."""
    there = df.where(F.col(value).isNotNull())
    return there.groupBy(*keys).pivot(model, models).agg(F.max_by(value, order))


def vote_pivot(df: DataFrame, key: str, flag: Column, yes: str = "votes_for", no: str = "votes_against") -> DataFrame:
    """(key, votes for, votes against), both there and 0 without a vote."""
    return df.groupBy(key).agg(F.count_if(flag).alias(yes), F.count_if(~flag).alias(no))


def majority(df: DataFrame, item: str, label: str, order: str, first: int = 3) -> DataFrame:
    """(item, label, agreement): the label most of an item's first annotators gave, ties to the earliest; agreement m/n."""
    early = df.where(F.col(label).isNotNull()).groupBy(item).agg(F.slice(F.array_sort(F.collect_list(F.struct(order, label))), 1, first).alias("votes"))
    labels = F.col(f"votes.{label}")
    counted = F.transform(labels, lambda x: F.struct(F.size(F.filter(labels, lambda y: y == x)).alias("n"), (-F.array_position(labels, x)).alias("at"), x.alias("x")))
    best = F.array_max(counted)
    return early.select(item, best["x"].alias("label"), F.concat_ws("/", best["n"].cast("string"), F.size(labels).cast("string")).alias("agreement"))


def fleiss_kappa(df: DataFrame, item: str, label: str, raters: int, digits: int = 6) -> DataFrame:
    """Agreement beyond chance of a fixed number of raters over all items; 1 where chance alone agrees always.

    Items with another number of labels are left out.
    """
    by = df.groupBy(item, label).agg(F.count("*").alias("n"))
    fit = by.groupBy(item).agg(F.sum("n").alias("r"), F.sum(F.col("n") * (F.col("n") - 1)).alias("agree")).where(F.col("r") == raters)
    inside = by.join(fit.select(item), item, "left_semi")
    observed = fit.agg(F.count("*").alias("items"), F.avg(F.col("agree") / (raters * (raters - 1))).alias("po"))
    shares = inside.groupBy(label).agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum("n").alias("all"))
    both = observed.crossJoin(shares)  # one row each
    pe = F.col("squares") / (F.col("all") * F.col("all"))
    return both.select("items", F.round("po", digits).alias("observed"), F.round(pe, digits).alias("expected"), F.round(F.when(pe == 1, 1.0).otherwise((F.col("po") - pe) / (1 - pe)), digits).alias("kappa"))


def gold_check(df: DataFrame, gold: DataFrame, item: str, annotator: str, label: str, gold_label: str) -> DataFrame:
    """(annotator, n_checked, n_wrong, accuracy, passed) on items with a known label."""
    both = df.join(gold.select(item, F.col(gold_label).alias("__gold")), item)
    wrong = F.count_if(~F.col(label).eqNullSafe(F.col("__gold")))
    return both.groupBy(annotator).agg(F.count("*").alias("n_checked"), wrong.alias("n_wrong"), F.round(1 - wrong / F.count("*"), 6).alias("accuracy"), (wrong == 0).alias("passed"))


def agreement_scores(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """(n, accuracy, cohen_kappa, f1_macro) of two label columns, from their confusion table."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).agg(F.count("*").alias("n"))
    ends = cells.select(F.explode(F.array(F.struct(F.col("x").alias("l"), F.col("n").alias("nx"), F.lit(0).alias("ny"), F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("y").alias("l"), F.lit(0).alias("nx"), F.col("n").alias("ny"), F.lit(0).alias("hit")))).alias("r")).select("r.*")
    by = ends.groupBy("l").agg(F.sum("nx").alias("nx"), F.sum("ny").alias("ny"), F.sum("hit").alias("hit"))
    s = by.agg(F.sum("nx").alias("n"), F.sum("hit").alias("hits"), F.sum(F.col("nx") * F.col("ny")).alias("chance"), F.avg(2 * F.col("hit") / (F.col("nx") + F.col("ny"))).alias("f1"))
    po, pe = F.col("hits") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    return s.select("n", F.round(po, digits).alias("accuracy"), F.round(F.when(pe == 1, 1.0).otherwise((po - pe) / (1 - pe)), digits).alias("cohen_kappa"), F.round("f1", digits).alias("f1_macro"))


def negatives_by_query(df: DataFrame, query: str, passage: str, negative: str, order: str) -> DataFrame:
    """(query, passage, negatives): the first passage, and the negatives with text in order; rows without a query or passage don't count."""
    there = df.where((F.trim(query) != "") & (F.trim(passage) != ""))
    listed = F.array_sort(F.collect_list(F.when(F.trim(negative) != "", F.struct(order, negative))))
    return there.groupBy(query).agg(F.min_by(passage, order).alias("passage"), F.transform(listed, lambda r: r[negative]).alias("negatives"))
