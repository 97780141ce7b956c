"""Problem 8: mixing sources to target weights.

The documents of each source are shuffled by a hash and laid end to end in
blocks of equal tokens, up to the source's target. Slots of the mixed stream are golden-ratio points
mapped through the cumulative weights of the sources, so every stretch of the
stream holds the sources in proportion; the r-th slot of a source takes its
block r, over and over as its passes allow.

Nothing here orders all rows of one source in one task: running sums and
ranks are taken within hash buckets or slot chunks and shifted by the totals
of those before them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.text import map_rows, source_name, token_count
from acequia.session import materialize

GOLDEN = (math.sqrt(5) - 1) / 2


def listed_documents(
    documents: DataFrame, targets: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """(doc_id, source, tokens) of the documents of the listed sources, each id once."""
    wanted = targets.select(source_name("source").alias("source")).distinct()
    return (
        documents.select(F.col(id_column).alias("doc_id"), source_name(source_column).alias("source"), text_column)
        .join(wanted, "source", "left_semi")
        .select("doc_id", "source", token_count(text_column).alias("tokens"))
        .groupBy("doc_id")
        .agg(F.min(F.struct("source", "tokens")).alias("d"))
        .select("doc_id", "d.source", "d.tokens")
    )


def mix_plan(sized: DataFrame, targets: DataFrame, block_tokens: int) -> DataFrame:
    """One row by listed source: size, target, passes, blocks, slots, and tokens of the last pass (rest).

    Repeated rows of a source in ``targets`` add their shares and allow the
    most passes among them; a null share counts as 0 and null passes as 1.
    """
    wanted = targets.groupBy(source_name("source").alias("source")).agg(
        F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"),
        F.max(F.greatest(F.coalesce("max_passes", F.lit(1)), F.lit(0))).cast("bigint").alias("max_passes"),
    )
    sizes = sized.groupBy("source").agg(F.sum("tokens").alias("size"), F.count("*").alias("n_docs"))
    plan = wanted.join(sizes, "source", "left").fillna(0, ["size", "n_docs"])
    total = sized.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    plan = plan.crossJoin(total)  # one row
    target = F.col("target_share") * F.col("total")
    full = F.ceil(target / F.col("size"))
    passes = F.when((F.col("size") > 0) & (target > 0), F.least(full, F.col("max_passes"))).otherwise(F.lit(0))
    reached = F.least(target, F.col("max_passes") * F.col("size"))
    blocks = F.ceil(F.col("size") / F.lit(block_tokens))
    before = F.greatest(F.col("passes") - 1, F.lit(0))
    return (
        plan.withColumn("target_tokens", target)
        .withColumn("passes", passes.cast("bigint"))
        .withColumn("falls_short", (F.col("max_passes") * F.col("size") < target).cast("bigint"))
        .withColumn("blocks", blocks.cast("bigint"))
        .withColumn("rest", F.when(F.col("passes") > 0, reached - before * F.col("size")).otherwise(F.lit(0.0)))
        .withColumn("slots", F.least(F.col("passes") * F.col("blocks"), before * F.col("blocks") + F.ceil(F.col("rest") / F.lit(block_tokens))).cast("bigint"))
    )


def schedule(plan: DataFrame, *, chunk: int = 1 << 16) -> DataFrame:
    """(position, source, rank): the source of each slot, and which of its slots it is.

    Points k * golden ratio mod 1 fall into the sources' intervals of the
    cumulative slot counts. Chunks of slots are counted first and ranked
    next, each chunk from the totals of the chunks before it. Where the
    sequence gives a source a few slots too many they are left out, and where
    too few they come last, so each source has exactly its slots.
    """
    spark = plan.sparkSession
    rows = [(r.source, r.slots) for r in plan.select("source", "slots").where("slots > 0").orderBy("source").toLocalIterator()]
    empty = "position bigint, source string, rank bigint"
    if not rows:
        return spark.createDataFrame([], empty)
    names = [r[0] for r in rows]
    slots = np.array([r[1] for r in rows], dtype=np.int64)
    total = int(slots.sum())
    edges = np.cumsum(slots / total)[:-1]
    chunks = -(-total // chunk)

    def points(c: int) -> tuple[np.ndarray, np.ndarray]:
        k = np.arange(c * chunk, min((c + 1) * chunk, total), dtype=np.int64)
        # the fraction of k times a 64-bit golden ratio, exact for any k
        frac = (k.astype(np.uint64) * np.uint64(11400714819323198485)).astype(np.float64) / 2.0**64
        return k, np.searchsorted(edges, frac, side="right")

    def count(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"c": [], "s": [], "n": []}
        for c in batch["id"]:
            n = np.bincount(points(c)[1], minlength=len(names))
            out["c"] += [c] * len(names)
            out["s"] += range(len(names))
            out["n"] += n.tolist()
        return out

    ids = spark.range(chunks, numPartitions=max(1, min(chunks, 4 * spark.sparkContext.defaultParallelism)))
    counts = map_rows(ids, count, "c bigint, s int, n bigint")
    before = F.sum("n").over(Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        counts.withColumn("before", F.coalesce(before, F.lit(0)))
        .groupBy("c")
        .agg(F.sort_array(F.collect_list(F.struct("s", "before", "n"))).alias("starts"))
    )

    def rank(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"position": [], "source": [], "rank": []}
        for c, starts in zip(batch["c"], batch["starts"]):
            k, s = points(c)
            r = np.empty(len(k), dtype=np.int64)
            for x in starts:
                mine = s == x["s"]
                r[mine] = x["before"] + np.arange(x["n"])
            keep = r < slots[s]
            out["position"] += k[keep].tolist()
            out["source"] += [names[i] for i in s[keep]]
            out["rank"] += r[keep].tolist()
        return out

    placed = map_rows(starts, rank, empty)
    given = {r.s: r.n for r in counts.groupBy("s").agg(F.sum("n").alias("n")).toLocalIterator()}
    late = [(names[i], g, int(n)) for i, n in enumerate(slots) if (g := given.get(i, 0)) < n]
    if not late:
        return placed
    rest = spark.createDataFrame(late, "source string, a bigint, b bigint").select(
        "source", F.explode(F.sequence("a", F.col("b") - 1)).alias("rank")
    )
    return placed.unionByName(rest.select((F.lit(total) + F.col("rank")).alias("position"), "source", "rank"))


def shuffled_blocks(sized: DataFrame, plan: DataFrame, block_tokens: int, seed: int, bucket_docs: int = 20_000) -> DataFrame:
    """(source, block, start, doc_id, tokens): the documents of each source shuffled by hash, with the block each begins in.

    Their order is that of the first 60 bits of a digest of seed and doc_id;
    buckets are ranges of it.
    """
    sized = sized.where("tokens > 0").join(plan.select("source", F.ceil(F.col("n_docs") / bucket_docs).alias("buckets")), "source")
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "doc_id")), 1, 15), 16, 10).cast("bigint")
    hashed = sized.withColumn("h", h).withColumn("bucket", F.shiftright(F.shiftright("h", 28) * F.col("buckets"), 32))
    sums = hashed.groupBy("source", "bucket").agg(F.sum("tokens").alias("t"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row by bucket
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        hashed.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(offsets, ["source", "bucket"])
        .withColumn("start", F.col("offset") + F.col("inside"))
        .select("source", F.floor(F.col("start") / F.lit(block_tokens)).alias("block"), "start", "doc_id", "tokens")
    )


def _planned(documents: DataFrame, targets: DataFrame, block_tokens: int, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    sized = materialize(listed_documents(documents, targets, **columns), "mix-sizes")
    return sized, materialize(mix_plan(sized, targets, block_tokens), "mix-plan")


def _mixed(sized: DataFrame, plan: DataFrame, block_tokens: int, seed: int) -> DataFrame:
    figures = plan.select("source", "blocks", (F.col("passes") - 1).alias("last"), "rest")
    slots = (
        schedule(plan)
        .join(figures, "source")
        .select("position", "source", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"), "last", "rest")
    )
    mixed = slots.join(shuffled_blocks(sized, plan, block_tokens, seed), ["source", "block"])
    # the last pass ends with the document that reaches the target
    return mixed.where((F.col("pass") < F.col("last")) | (F.col("start") < F.col("rest"))).select("position", "source", "pass", "start", "doc_id", "tokens")


def mix_report(documents: DataFrame, targets: DataFrame, *, block_tokens: int = 2048, seed: int = 7, **columns: str) -> DataFrame:
    """(source, size, target_tokens, passes, falls_short, mixed_tokens, mixed_share) for each listed source.

    ``passes``, ``mixed_tokens`` and the shares are summed up from the mixed
    stream itself: a source has at least the least of its target and of all
    its passes, and less than one document more. Sources without a token get
    0 passes; null and empty texts have no tokens; repeated rows of a
    document count once; with no documents all figures are 0.
    """
    sized, plan = _planned(documents, targets, block_tokens, columns)
    used = _mixed(sized, plan, block_tokens, seed).groupBy("source").agg((F.max("pass") + 1).cast("bigint").alias("passes"), F.sum("tokens").alias("mixed_tokens"))
    report = plan.select("source", "size", "target_tokens", "falls_short").join(used, "source", "left").fillna(0, ["passes", "mixed_tokens"])
    whole = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))  # one row by source
    return report.select(
        "source", "size", "target_tokens", "passes", "falls_short", "mixed_tokens",
        F.when(whole > 0, F.col("mixed_tokens") / whole).otherwise(F.lit(0.0)).alias("mixed_share"),
    )


def mix(documents: DataFrame, targets: DataFrame, *, block_tokens: int = 2048, seed: int = 7, **columns: str) -> DataFrame:
    """(position, source, pass, start, doc_id, tokens): the mixed stream, to be ordered by position and start.

    A document goes with the block in which it begins, whole; the last pass
    of a source ends with the document that reaches its target. See
    mix_report for nulls, repeated rows and empty tables.
    """
    sized, plan = _planned(documents, targets, block_tokens, columns)
    return _mixed(sized, plan, block_tokens, seed)
