"""The corpus pipeline: named steps, from raw tables to a sampled corpus.

Steps are functions of a table and a context; a run takes all, one, or a
range of them, and writes each result, so a later run can begin anywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.functions.text import clean, token_count
from acequia.operators import dedup, filters, joins, minhash, projection, quality, sampling
from acequia.sources import readers


@dataclass
class Context:
    """Where a corpus is written and what its steps are given."""

    spark: SparkSession
    root: str
    options: dict[str, dict] = field(default_factory=dict)

    def of(self, step: str) -> dict:
        return self.options.get(step, {})


def initial(_: DataFrame | None, context: Context) -> DataFrame:
    """Datasets by name, their core columns as one corpus."""
    frames = [projection.core(readers.parquet(context.spark, [path]), name) for name, path in context.of("initial")["datasets"].items()]
    return dedup.stack(*frames)


def cleaned(df: DataFrame | None, context: Context) -> DataFrame:
    return df.withColumn("text", clean(F.col("text"), **context.of("clean"))).withColumn("tokens", token_count(F.col("text")))


def curated(df: DataFrame | None, context: Context) -> DataFrame:
    """Language first, near-duplicates second, quality last."""
    o = context.of("curate")
    if o.get("frequent_words"):
        df = df.where(filters.language_score(F.col("text"), o["frequent_words"]) >= o.get("language_threshold", 0.1))
    df = df.withColumn("__key", F.concat_ws("|", "source_id", "id"))
    df = minhash.minhash_dedup(df, "text", "__key", **o.get("minhash", {})).drop("__key")
    reasons = F.concat(quality.repetition_reasons(F.col("text")), quality.web_reasons(F.col("text")), quality.document_reasons(F.col("text")))
    return filters.kept(df.withColumn("reasons", reasons)).drop("reasons")


def completed(df: DataFrame | None, context: Context) -> DataFrame:
    """Source names mapped, metadata of the datasets attached as JSON."""
    o = context.of("complete")
    if "mapping" in o:
        df = joins.map_sources(df, o["mapping"])
    if "metadata" in o:
        df = joins.enrich(df, o["metadata"], ["source_id", "id"], ["metadata"])
    return df


def sampled(df: DataFrame | None, context: Context) -> DataFrame:
    o = dict(context.of("sample"))
    return sampling.perform(o.pop("task"), df, group="source_id", id_column="id", **o) if o else df


STEPS: dict[str, Callable[[DataFrame | None, Context], DataFrame]] = {"initial": initial, "clean": cleaned, "curate": curated, "complete": completed, "sample": sampled}


def chosen_steps(single: str | None = None, start: str | None = None, end: str | None = None) -> list[str]:
    names = list(STEPS)
    for n in (single, start, end):
        if n is not None and n not in names:
            raise ValueError(f"unknown step {n}; known: {', '.join(names)}")
    if single:
        return [single]
    a = names.index(start) if start else 0
    b = names.index(end) + 1 if end else len(names)
    if a >= b:
        raise ValueError(f"{start} comes after {end}")
    return names[a:b]


def run(context: Context, *, single: str | None = None, start: str | None = None, end: str | None = None, force: bool = False) -> DataFrame:
    """Run steps in order; a step whose result is there is skipped unless forced. The last result."""
    path = lambda n: f"{context.root.rstrip('/')}/{n}.parquet"
    todo = chosen_steps(single, start, end)
    names = list(STEPS)
    for n in todo:
        if not force and readers.exists(context.spark, path(n)):
            continue
        at = names.index(n)
        before = context.spark.read.parquet(path(names[at - 1])) if at else None
        STEPS[n](before, context).write.mode("overwrite").parquet(path(n))
    return context.spark.read.parquet(path(todo[-1]))
