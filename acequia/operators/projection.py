"""Columns: election, renaming, casting, metadata, conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Candidates for the text column, best first.
TEXT_COLUMNS = ["pdf_content", "pdf_text", "html_content", "contenido", "content", "text", "txt"]
ID_COLUMNS = ["identificador", "Identificador"]


def core(df: DataFrame, source: str, id_column: str = "id", text: str = "text") -> DataFrame:
    """(source_id, id, text) as strings."""
    return df.select(F.lit(source).alias("source_id"), F.col(id_column).cast("string").alias("id"), F.col(text).cast("string").alias("text"))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def elect_text(df: DataFrame) -> DataFrame:
    """The best candidate becomes ``text``; the other candidates are dropped."""
    found = [c for c in TEXT_COLUMNS if c in df.columns]
    if not found:
        return df
    kept = [c for c in df.columns if c not in found[1:]]
    return df.select(*[F.col(c).alias("text") if c == found[0] else F.col(c) for c in kept])


def rename_id(df: DataFrame) -> DataFrame:
    for c in ID_COLUMNS:
        if c in df.columns and "id" not in df.columns:
            return df.withColumnRenamed(c, "id")
    return df


def rename_by(df: DataFrame, mapping: dict[str, str] | DataFrame, old: str = "original_column_name", new: str = "mapped_column_name") -> DataFrame:
    """Columns renamed by a mapping; those that aren't there are left out of account."""
    if isinstance(mapping, DataFrame):
        missing = {old, new} - set(mapping.columns)
        if missing:
            raise ValueError(f"mapping lacks {sorted(missing)}")
        mapping = {r[0]: r[1] for r in mapping.select(old, new).toLocalIterator()}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def flat_as_text(df: DataFrame) -> DataFrame:
    """All columns but lists, maps and structs as strings."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.col(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string").alias(f.name) for f in df.schema])


def to_metadata(df: DataFrame, keep: list[str], name: str = "metadata") -> DataFrame:
    """The columns besides ``keep`` as one JSON text with its nulls; ``{}`` if there are none."""
    rest = [c for c in df.columns if c not in keep]
    packed = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")
    return df.select(*keep, packed.alias(name))


def instruction_text(system: Column, question: Column, response: Column) -> Column:
    """The three with line breaks between; null if any is null."""
    return F.concat(system, F.lit("\n"), question, F.lit("\n"), response)


def fold_conversation(system: Column, question: Column, response: Column) -> Column:
    """Turns of system, human and gpt; the system turn is empty. Raises on a null question or answer."""
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    checked = lambda c: F.when(c.isNull(), F.raise_error(F.lit("question or response is null"))).otherwise(c).cast("string")
    return F.array(turn("system", F.lit("")), turn("human", checked(question)), turn("gpt", checked(response)))


def unfold_conversation(turns: Column) -> Column:
    """(system_prompt, question, response): the last turn of each role, or the empty text."""
    def last(role: str) -> Column:
        mine = F.filter(turns, lambda t: t["from"] == role)
        return F.coalesce(F.try_element_at(mine, F.lit(-1))["value"], F.lit(""))

    return F.struct(last("system").alias("system_prompt"), last("human").alias("question"), last("gpt").alias("response"))


def from_file_name(df: DataFrame, names: list[str], path: Column | None = None) -> DataFrame:
    """Columns of the parts of the file's name between dashes."""
    stem = F.regexp_replace(F.substring_index(path if path is not None else F.col("_metadata.file_path"), "/", -1), r"\.[^.]*$", "")
    parts = F.split(stem, "-")
    return df.select("*", *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def coalesced(df: DataFrame, name: str, candidates: list[str]) -> DataFrame:
    """One column of the first value there among candidates that exist."""
    there = [F.col(c) for c in candidates if c in df.columns]
    return df.withColumn(name, F.coalesce(*there) if there else F.lit(None).cast("string"))


def first_or_null(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


def empty_if_null(c: Column, of: str = "string") -> Column:
    return F.coalesce(c, F.array().cast(f"array<{of}>"))


def public_columns(df: DataFrame, source_file: str = "_source_file", source_line: str = "_source_line") -> DataFrame:
    """Without columns that begin with an underscore; where a row came from goes into its metadata."""
    shown = [c for c in df.columns if not c.startswith("_") and c != "metadata"]
    inside = df.schema["metadata"].dataType.fieldNames() if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, T.StructType) else []
    fields = [F.col(f"metadata.{f}").alias(f) for f in inside if f not in ("source_file", "source_line")]
    for name, own in (("source_file", source_file), ("source_line", source_line)):
        have = [F.col(f"metadata.{name}")] if name in inside else []
        if own in df.columns:
            have.append(F.col(own))
        fields.append((F.coalesce(*have) if have else F.lit(None)).alias(name))
    return df.select(*shown, F.struct(*fields).alias("metadata"))


def queries_and_passages(df: DataFrame, id_query: str, query: str, id_passage: str, passage: str, answer: str) -> dict[str, DataFrame]:
    """Queries, references and contexts of question rows; rows without a query or passage are left out, an empty answer stays."""
    there = df.where((F.trim(query) != "") & (F.trim(passage) != ""))
    return {
        "queries": there.select(F.col(id_query).alias("id_query"), F.col(query).alias("user_input")),
        "references": there.select(F.col(id_query).alias("id_query"), F.col(id_passage).alias("id_passage"), F.coalesce(answer, F.lit("")).alias("reference")),
        "contexts": there.select(F.col(id_query).alias("id_query"), F.array(passage).alias("reference_contexts")),
    }


def unify(df: DataFrame, schemas: list[dict[str, str]]) -> DataFrame:
    """The first of several schemas (target name to source name) that the frame has, projected; raises if none."""
    for schema in schemas:
        if set(schema.values()) <= set(df.columns):
            return df.select(*[F.col(old).alias(new) for new, old in schema.items()])
    raise ValueError(f"no known schema in {df.columns}")


def chunk_ids(source: Column, document: Column, number: Column) -> Column:
    """source-document-number: blanks to underscores, the last part of a path."""
    tidy = lambda c: F.regexp_replace(F.substring_index(c, "\\", -1), " ", "_")
    return F.concat_ws("-", tidy(source), tidy(document), number.cast("string"))


def both_directions(df: DataFrame, a: str, b: str) -> DataFrame:
    """(source_text, target_text, direction): each pair of texts both ways."""
    one = lambda x, y, d: F.struct(F.col(x).alias("source_text"), F.col(y).alias("target_text"), F.lit(d).alias("direction"))
    kept = [c for c in df.columns if c not in (a, b)]
    return df.select(*kept, F.explode(F.array(one(a, b, f"{a}>{b}"), one(b, a, f"{b}>{a}"))).alias("r")).select(*kept, "r.*")


def fan_out(df: DataFrame, items: str, id_column: str, most: int = 10) -> DataFrame:
    """One row by item of a list, up to ``most``, with its number after the id."""
    kept = [c for c in df.columns if c not in (items, id_column)]
    return df.select(F.col(id_column).alias("__id"), *kept, F.posexplode(F.slice(items, 1, most)).alias("__n", "item")).select(
        F.concat_ws("_", F.col("__id").cast("string"), (F.col("__n") + 1).cast("string")).alias(id_column), *kept, "item"
    )


def contrastive_rows(df: DataFrame, query: str, positives: str, negatives: str) -> DataFrame:
    """(query, passage, label): positives with 1, negatives with 0."""
    flat = lambda c, y: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda p: F.struct(p.alias("passage"), F.lit(y).alias("label")))
    return df.select(F.col(query).alias("query"), F.explode(F.concat(flat(positives, 1), flat(negatives, 0))).alias("r")).select("query", "r.*")


def triplets(df: DataFrame, query: str, positives: str, negatives: str) -> DataFrame:
    """(query, positive, negative): the first of each; rows without one are left out."""
    return df.select(F.col(query).alias("query"), first_or_null(F.col(positives)).alias("positive"), first_or_null(F.col(negatives)).alias("negative")).dropna()


def running_id(df: DataFrame, source: Column, order: list[str], name: str = "id") -> DataFrame:
    """source_n with n from 1 in order."""
    from acequia.operators.ordering import position

    return position(df, order, "__place").select(*df.columns, F.concat_ws("_", source, (F.col("__place") + 1).cast("string")).alias(name))
