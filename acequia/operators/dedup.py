"""Set operations and exact de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.text import TOKEN, hash_parts, squeeze


def stack(*frames: DataFrame, widen: bool = False) -> DataFrame:
    """Rows of all frames; columns some lack are null there. With ``widen`` columns of different types become text."""
    if widen:
        kinds: dict[str, set[str]] = {}
        for f in frames:
            for name, kind in f.dtypes:
                kinds.setdefault(name, set()).add(kind)
        wide = {n for n, k in kinds.items() if len(k) > 1}
        frames = tuple(f.select(*[F.col(c).cast(_wider(kinds[c])) if c in wide else F.col(c) for c in f.columns]) for f in frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _wider(kinds: set[str]) -> str:
    order = ["boolean", "tinyint", "smallint", "int", "bigint", "float", "double"]
    return max(kinds, key=order.index) if kinds <= set(order) and "boolean" not in kinds else "string"


def _digest(keys: list[Column]) -> Column:
    """A hash of key values in which a null differs from any text."""
    return F.sha2(F.to_json(F.struct(*[k.cast("string").alias(f"k{i}") for i, k in enumerate(keys)])), 256)


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The first row of each key in an order that must be total.

    By a partial aggregate, not a window: a key with a third of all rows
    shrinks to one row a task before anything is shuffled. Only a hash of the
    key and the order are grouped; whole rows are picked by them afterwards,
    so no text but those that stay is moved. Equal rows count once.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    keyed = df.withColumn("__h", _digest(columns))
    firsts = keyed.groupBy("__h").agg(F.min(F.struct(*order)).alias("__o")).select(F.col("__h").alias("__fh"), *[F.col(f"__o.{c}").alias(f"__f{i}") for i, c in enumerate(order)])
    same = F.col("__h") == F.col("__fh")
    for i, c in enumerate(order):
        same = same & F.col(c).eqNullSafe(F.col(f"__f{i}"))
    return keyed.join(firsts, same, "left_semi").dropDuplicates(["__h", *order]).drop("__h")


def text_dedup(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row by text, the one with the least id; rows with a null text count as one text.

    Only hashes are grouped; the rows are then picked by id, so a text with a
    third of all rows is one row a task before the shuffle and spread after it.
    """
    firsts = df.groupBy(F.sha2(text, 256).alias("__h")).agg(F.min(id_column).alias(id_column)).select(id_column)
    return df.join(firsts, id_column, "left_semi").dropDuplicates([id_column])


def text_groups(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(first_id, copies): every text that stands more than once, by its least id."""
    return df.groupBy(F.sha2(text, 256).alias("h")).agg(F.min(id_column).alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("first_id", "copies")


def duplicate_ids(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, first_id, copies) of every row whose text stands more than once."""
    h = F.sha2(text, 256)
    groups = df.groupBy(h.alias("__g")).agg(F.min(id_column).alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    return df.select(F.col(id_column).alias("id"), h.alias("__h")).join(groups, F.col("__h").eqNullSafe(F.col("__g"))).select("id", "first_id", "copies")


def text_then_id_dedup(df: DataFrame, text: str = "text", id_column: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """One row by text, then one by id.

    Both steps work on hashes, ids and the order; the rows that stay are then
    picked from the table at once.
    """
    order = order or [id_column]
    light = df.select(_digest([F.col(text)]).alias("__t"), F.col(id_column).alias("__id"), F.struct(*order).alias("__o"))
    once = light.groupBy("__t").agg(F.min(F.struct("__o", "__id")).alias("r")).select("__t", "r.__o", "r.__id")
    first = once.groupBy("__id").agg(F.min(F.struct("__o", "__t")).alias("r")).select(F.col("r.__t").alias("__ft"), F.col("r.__o").alias("__fo"), F.col("__id").alias("__fid"))
    keyed = df.withColumn("__t", _digest([F.col(text)])).withColumn("__o", F.struct(*order))
    same = (F.col("__t") == F.col("__ft")) & F.col(id_column).eqNullSafe(F.col("__fid")) & F.col("__o").eqNullSafe(F.col("__fo"))
    return keyed.join(first, same, "left_semi").dropDuplicates(["__t", "__o", id_column]).drop("__t", "__o")


def merge_new(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Existing rows, and of the new ones the first by each key that isn't there yet."""
    return existing.unionByName(keep_first(new, list(keys), order).join(existing.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def unprocessed(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't among those done."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def fingerprint_groups(df: DataFrame, columns: list[str], id_column: str, tokens: int = 80) -> DataFrame:
    """(first_id, copies): rows that begin with the same tokens in all of the columns."""
    heads = [F.array_join(F.slice(F.regexp_extract_all(F.lower(squeeze(F.col(c))), F.lit(f"({TOKEN})"), F.lit(1)), 1, tokens), " ") for c in columns]
    return df.groupBy(hash_parts(*heads).alias("h")).agg(F.min(id_column).alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("first_id", "copies")


def duplicate_counts(df: DataFrame, key: Column) -> DataFrame:
    """(groups, extra_rows, rows_in_groups) of keys that stand more than once."""
    by = df.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    return by.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"))


def best_record(df: DataFrame, keys: list[str], valid: Column, order: list[str]) -> DataFrame:
    """Of each key, a valid record before an invalid one, and the earliest of those."""
    marked = df.withColumn("__invalid", ~F.coalesce(valid, F.lit(False)))
    return keep_first(marked, list(keys), ["__invalid", *order]).drop("__invalid")


def topic_window_size(df: DataFrame, group: str, least: int) -> DataFrame:
    """Rows of the groups with ``least`` rows or more."""
    big = df.groupBy(group).agg(F.count("*").alias("__n")).where(F.col("__n") >= least).select(group)
    return df.join(big, group, "left_semi")


def keep_last_window(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by a window: for keys with few rows."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
