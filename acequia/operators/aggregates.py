"""Statistics of corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_stats(df: DataFrame, source: str = "source", tokens: str = "tokens") -> DataFrame:
    """(source, n_docs, n_tokens, docs_pct, tokens_pct)."""
    by = df.groupBy(source).agg(F.count("*").alias("n_docs"), F.sum(tokens).alias("n_tokens"))
    return with_shares(by, {"n_docs": "docs_pct", "n_tokens": "tokens_pct"})


def with_shares(df: DataFrame, columns: dict[str, str], digits: int = 6) -> DataFrame:
    """Each value's percentage of its column's total, for tables of one row by group."""
    whole = Window.partitionBy(F.lit(1))
    for c, name in columns.items():
        df = df.withColumn(name, F.round(F.col(c) * 100.0 / F.sum(c).over(whole), digits))
    return df


def statistics(df: DataFrame, criteria: list[str], tokens: str = "tokens") -> DataFrame:
    """(statistic_type, category, n_rows, total_tokens, avg_tokens): overall, by each criterion, and by all of them together."""
    sets = [[], *[[c] for c in criteria]] + ([criteria] if len(criteria) > 1 else [])
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *criteria).agg(
        F.grouping_id().alias("__g"), F.count("*").alias("n_rows"), F.sum(tokens).alias("total_tokens"), F.round(F.avg(tokens), 6).alias("avg_tokens")
    )
    full = (1 << len(criteria)) - 1
    kind, value = F.lit("overall"), F.lit("all")
    for i, c in enumerate(criteria):
        alone = full & ~(1 << (len(criteria) - 1 - i))
        kind = F.when(F.col("__g") == alone, c).otherwise(kind)
        value = F.when(F.col("__g") == alone, F.coalesce(F.col(c).cast("string"), F.lit("null"))).otherwise(value)
    if len(criteria) > 1:
        kind = F.when(F.col("__g") == 0, "-".join(criteria)).otherwise(kind)
        value = F.when(F.col("__g") == 0, F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in criteria])).otherwise(value)
    return grouped.select(kind.alias("statistic_type"), value.alias("category"), "n_rows", "total_tokens", "avg_tokens")


def domain_rollup(df: DataFrame, domain: str, tokens: str, size: str) -> DataFrame:
    """(domain, n, tokens, tokens_millions, tokens_billions, size) of registered resources."""
    by = df.groupBy(domain).agg(F.count("*").alias("n_resources"), F.sum(tokens).alias("tokens"), F.round(F.sum(size), 4).alias("size"))
    return by.withColumn("tokens_millions", F.round(F.col("tokens") / 1e6, 4)).withColumn("tokens_billions", F.round(F.col("tokens") / 1e9, 4))


def upsert(registry: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The registry with rows of the same key replaced."""
    return registry.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def values(df: DataFrame, column: str) -> DataFrame:
    """Different values of a column, lists taken apart, empty texts left out."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() == "array":
        c = F.explode(c)
    v = df.select(c.cast("string").alias("value"))
    return v.where(F.trim("value") != "").distinct()


def tokens_by_value(df: DataFrame, column: str, tokens: str = "tokens") -> DataFrame:
    """(value, n_rows, tokens), and beside them mean and deviation over the values."""
    by = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n_rows"), F.sum(tokens).alias("tokens"))
    whole = Window.partitionBy(F.lit(1))
    return by.withColumn("mean_tokens", F.round(F.avg("tokens").over(whole), 6)).withColumn("stddev_tokens", F.round(F.stddev_pop("tokens").over(whole), 6))


def distribution(df: DataFrame, column: str, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Count, least, quartiles, mean, 95th percentile and greatest, quantiles by linear interpolation."""
    c = F.col(column).cast("double")
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.95)))
    out = df.groupBy(*(by or [])).agg(F.count(c).alias("n"), F.min(c).alias("min"), q.alias("q"), F.avg(c).alias("mean"), F.max(c).alias("max"))
    r = lambda x, name: F.round(x, digits).alias(name)
    return out.select(*(by or []), "n", r(F.col("min"), "min"), r(F.col("q")[0], "p25"), r(F.col("q")[1], "median"), r(F.col("mean"), "mean"), r(F.col("q")[2], "p75"), r(F.col("q")[3], "p95"), r(F.col("max"), "max"))


def reason_summary(df: DataFrame, file: str, reasons: str = "reasons") -> DataFrame:
    """(file, reason, n): rows of each reason by file and over all; a row counts under each of its reasons."""
    one = df.select(F.col(file).alias("file"), F.explode(reasons).alias("reason"))
    both = one.groupingSets([[F.col("file"), F.col("reason")], [F.col("reason")]], "file", "reason").agg(F.grouping("file").alias("g"), F.count("*").alias("n"))
    return both.select(F.when(F.col("g") == 1, "ALL").otherwise(F.coalesce("file", F.lit("null"))).alias("file"), "reason", "n")


def kept_summary(df: DataFrame, file: str, reasons: str = "reasons") -> DataFrame:
    """(file, n_rows, n_kept, n_removed, kept_pct) by file and over all."""
    gone = (F.size(reasons) > 0).cast("bigint")
    both = df.select(F.col(file).alias("file"), gone.alias("gone")).rollup("file").agg(F.grouping("file").alias("g"), F.count("*").alias("n_rows"), F.sum("gone").alias("n_removed"))
    kept = F.col("n_rows") - F.col("n_removed")
    return both.select(F.when(F.col("g") == 1, "ALL").otherwise(F.coalesce("file", F.lit("null"))).alias("file"), "n_rows", kept.alias("n_kept"), "n_removed", F.round(100.0 * kept / F.col("n_rows"), 6).alias("kept_pct"))


def chunk_stats(df: DataFrame, text: str, tokens: str, valid: str, document: str) -> DataFrame:
    """One row about a table of chunks."""
    return df.agg(
        F.count("*").alias("n_chunks"), F.count_if(F.col(valid)).alias("n_valid"), F.countDistinct(document).alias("n_documents"),
        F.round(F.avg(tokens), 6).alias("mean_tokens"), F.min(tokens).alias("min_tokens"), F.max(tokens).alias("max_tokens"), F.round(F.median(tokens), 6).alias("median_tokens"),
        F.round(F.avg(F.length(text)), 6).alias("mean_chars"), F.min(F.length(text)).alias("min_chars"), F.max(F.length(text)).alias("max_chars"),
    )


def metric_summary(df: DataFrame, metrics: list[str], digits: int = 6) -> DataFrame:
    """(metric, n, min, max, mean, median, std) over the values there; deviation of the population; nulls for a metric without any."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.nanvl(F.col(m).cast("double"), F.lit(None)).alias("v")) for m in metrics])).alias("r")).select("r.*")
    by = long.groupBy("metric").agg(F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.percentile("v", F.lit(0.5)).alias("median"), F.stddev_pop("v").alias("std"))
    return by.select("metric", "n", *[F.round(c, digits).alias(c) for c in ("min", "max", "mean", "median", "std")])


def wins(df: DataFrame, model: Column) -> DataFrame:
    """(model, n_wins, pct)."""
    return with_shares(df.groupBy(model.alias("model")).agg(F.count("*").alias("n_wins")), {"n_wins": "pct"})


def distribution_of(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share) of a column, lists taken apart."""
    c = F.explode(column) if df.schema[column].dataType.typeName() == "array" else F.col(column)
    by = df.select(c.alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    return by.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def cluster_sizes(df: DataFrame, cluster: str, dominant: float = 0.4) -> DataFrame:
    """(cluster, n, share, dominates)."""
    return distribution_of(df, cluster).select(F.col("value").alias("cluster"), "n", "share", (F.col("share") > dominant).alias("dominates"))


def system_score(df: DataFrame, score: str, by: list[str]) -> DataFrame:
    """Mean of segment scores, 0 without any."""
    return df.groupBy(*by).agg(F.round(F.coalesce(F.avg(score), F.lit(0.0)), 6).alias("system_score"), F.count(score).alias("n_segments"))
