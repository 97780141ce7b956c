"""Retrieval and similarity metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTOFFS = (1, 3, 5, 10, 20)


def hit_at(reference: Column, ids: Column, k: int) -> Column:
    """1 or 0 as the reference is among the first k; null without a reference; 0 without a list."""
    first = F.slice(F.coalesce(ids, F.array().cast("array<string>")), 1, k)
    return F.when(reference.isNotNull(), F.array_contains(F.transform(first, lambda x: x.cast("string")), reference.cast("string")).cast("int"))


def ir_metrics(hits: DataFrame, relevant: DataFrame, cutoffs: tuple[int, ...] = CUTOFFS, digits: int = 6) -> DataFrame:
    """(metric, k, value): NDCG, MAP, MRR, recall and precision, means over the queries with relevant items.

    hits: (query_id, id, rank); relevant: (query_id, id), each pair once.
    """
    rel = relevant.select("query_id", "id").distinct()
    n_rel = rel.groupBy("query_id").agg(F.count("*").alias("n_rel"))
    good = hits.join(rel, ["query_id", "id"], "left_semi").select("query_id", "rank")
    order = Window.partitionBy("query_id").orderBy("rank")  # at most the longest cutoff a query
    found = good.where(F.col("rank") <= max(cutoffs)).withColumn("seen", F.row_number().over(order))
    per = []
    for k in cutoffs:
        inside = F.col("rank") <= k
        per += [
            F.sum(F.when(inside, 1 / F.log2(F.col("rank") + 1))).alias(f"dcg_{k}"),
            F.sum(F.when(inside, F.col("seen") / F.col("rank"))).alias(f"ap_{k}"),
            F.max(F.when(inside, 1 / F.col("rank"))).alias(f"rr_{k}"),
            F.count_if(inside).alias(f"n_{k}"),
        ]
    by = n_rel.join(found.groupBy("query_id").agg(*per), "query_id", "left").fillna(0)
    out = []
    for k in cutoffs:
        least = F.least("n_rel", F.lit(k))
        ideal = F.aggregate(F.sequence(F.lit(1), least.cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + F.lit(1.0)))
        values = {"ndcg": F.col(f"dcg_{k}") / ideal, "map": F.col(f"ap_{k}") / least, "mrr": F.col(f"rr_{k}"), "recall": F.col(f"n_{k}") / F.col("n_rel"), "precision": F.col(f"n_{k}") / k}
        out += [F.struct(F.lit(m).alias("metric"), F.lit(k).alias("k"), F.round(F.avg(v), digits).alias("value")) for m, v in values.items()]
    return by.agg(F.array(*out).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def correlations(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """(pearson, spearman) of two columns; ranks of ties are averaged.

    Ranks come from counts of the distinct values, so no single task sorts all rows.
    """
    there = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))

    def ranks(c: str) -> DataFrame:
        from acequia.operators.ordering import position

        by = there.groupBy(c).agg(F.count("*").alias("n"))
        placed = position(by, [c], "at")
        w = Window.partitionBy(F.floor(F.col("at") / 100_000))
        sums = placed.withColumn("blk", F.floor(F.col("at") / 100_000)).groupBy("blk").agg(F.sum("n").alias("t"))
        starts = sums.select("blk", F.coalesce(F.sum("t").over(Window.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
        upto = F.sum("n").over(w.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        return placed.withColumn("upto", upto).withColumn("blk", F.floor(F.col("at") / 100_000)).join(F.broadcast(starts), "blk").select(c, (F.col("s") + F.col("upto") - (F.col("n") - 1) / 2).alias(f"r{c}"))

    ranked = there.join(ranks("a"), "a").join(ranks("b"), "b")
    return ranked.agg(F.round(F.corr("a", "b"), digits).alias("pearson"), F.round(F.corr("ra", "rb"), digits).alias("spearman"))


def corpus_bleu(df: DataFrame, hypothesis: str, reference: str, orders: int = 4, digits: int = 6) -> DataFrame:
    """(bleu, hypothesis_tokens, reference_tokens): corpus BLEU on lower-case tokens.

    Matches and totals are summed over all segments and put together once;
    each batch of segments gives one row of sums. Null texts have no tokens.
    """
    from collections.abc import Iterator

    import pandas as pd

    from acequia.functions.measures import _TOKEN, _grams, _shared

    names = ["hl", "rl", *[f"{x}{n}" for n in range(1, orders + 1) for x in "mt"]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sums = dict.fromkeys(names, 0)
            for a, b in zip(f["h"], f["r"]):
                h, r = (_TOKEN.findall((t or "").lower()) for t in (a, b))
                sums["hl"] += len(h)
                sums["rl"] += len(r)
                for n in range(1, orders + 1):
                    g = _grams(h, n)
                    sums[f"m{n}"] += _shared(g, _grams(r, n))
                    sums[f"t{n}"] += g.total()
            yield pd.DataFrame([sums])

    rows = df.select(F.col(hypothesis).alias("h"), F.col(reference).alias("r")).mapInPandas(run, ", ".join(f"{n} bigint" for n in names))
    s = rows.agg(*[F.sum(n).alias(n) for n in names])
    logs = F.lit(0.0)
    for n in range(1, orders + 1):
        logs = logs + F.log(F.col(f"m{n}") / F.col(f"t{n}")) / orders
    short = F.when(F.col("hl") < F.col("rl"), F.exp(1 - F.col("rl") / F.col("hl"))).otherwise(F.lit(1.0))
    return s.select(F.round(F.coalesce(short * F.exp(logs), F.lit(0.0)), digits).alias("bleu"), F.col("hl").alias("hypothesis_tokens"), F.col("rl").alias("reference_tokens"))
