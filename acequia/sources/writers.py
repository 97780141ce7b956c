"""Writers of corpora and of what was left out of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.sources.readers import exists


def task_path(root: str, task: str, sources: list[str] | None, target: int) -> str:
    """A file name that says task, sources and target."""
    part = "-".join(s.lower().replace(" ", "_") for s in sources) if sources else "all"
    return f"{root.rstrip('/')}/{task.replace('_', '-')}--{part}--{target}"


def write_twin(df: DataFrame, path: str, force: bool = False) -> bool:
    """Parquet and JSON lines side by side; an existing part is left as it is unless forced. Whether anything was written."""
    spark = df.sparkSession
    wrote = False
    if force or not exists(spark, f"{path}.parquet"):
        df.write.mode("overwrite" if force else "errorifexists").parquet(f"{path}.parquet")
        wrote = True
    if force or not exists(spark, f"{path}.jsonl"):
        spark.read.parquet(f"{path}.parquet").write.mode("overwrite" if force else "errorifexists").json(f"{path}.jsonl", ignoreNullFields=False)
        wrote = True
    return wrote


def write_parts(df: DataFrame, path: str, order: list[str], parts: int) -> None:
    """As many parts of consecutive rows, each in a folder of its own; the last one takes the remainder."""
    from acequia.operators.sampling import contiguous_parts

    contiguous_parts(df, order, parts).write.partitionBy("part").parquet(path)


def write_rejected(df: DataFrame, path: str, reasons: str = "reasons") -> None:
    """Rejected rows by their first reason."""
    df.where(F.size(reasons) > 0).withColumn("reason", F.col(reasons)[0]).write.partitionBy("reason").json(path)


def write_csv(df: DataFrame, path: str, columns: list[str], lists: list[str] | None = None) -> None:
    """Columns in that order with a header; lists are joined by a bar."""
    shown = [F.concat_ws("|", c).alias(c) if c in (lists or []) else F.col(c) for c in columns]
    df.select(*shown).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("quote", "\"").option("escape", "\"").csv(path)


def append_new(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Existing rows and the new ones of other keys; see merge_new."""
    from acequia.operators.dedup import merge_new

    return merge_new(existing, new, keys, order)


def append_distinct(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Different rows of both."""
    return existing.unionByName(new, allowMissingColumns=True).distinct()


def tagged(frames: dict[str, DataFrame], id_column: str = "id", text: str = "text") -> DataFrame:
    """(id, source, text) of several tables, each with its name."""
    out = None
    for name, df in frames.items():
        part = df.select(F.col(id_column).cast("string").alias("id"), F.lit(name).alias("source"), F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables")
    return out
