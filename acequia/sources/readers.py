"""Readers of the formats that corpora come in."""

from __future__ import annotations

import unicodedata
import warnings

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def parquet(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """Those of the paths that exist, as one table; the others with a warning. Raises if there is none."""
    there = [p for p in paths if exists(spark, p)]
    for p in set(paths) - set(there):
        warnings.warn(f"{p} is missing and was skipped", stacklevel=2)
    if not there:
        raise FileNotFoundError(f"none of {paths}")
    df = spark.read.parquet(*there)
    return df.select(*columns) if columns else df


def parquet_tree(spark: SparkSession, root: str, columns: list[str], pattern: str = "*.parquet") -> DataFrame:
    """All files below a folder, schemas merged, projected."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root).select(*columns)


def jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None, bad: str = "fail") -> DataFrame:
    """Lines of JSON, gzip too; blank lines are skipped, a byte-order mark is too. A bad line fails or is dropped."""
    reader = spark.read.option("mode", {"fail": "FAILFAST", "drop": "DROPMALFORMED"}[bad])
    if schema is None:
        return reader.json(path)
    return reader.schema(schema).json(path)


def jsonl_captured(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns of the schema, with _invalid_json, _source_file and _source_line (from 1).

    Files are read in splits, however long: a line's number is its place in
    its split and the lines of the splits before, which are counted first.
    Blank lines keep their number and are left out.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row"))
    blocks = lines.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    ahead = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # one row by split
    starts = blocks.select("__file", "__block", "__first", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    placed = lines.join(starts, ["__file", "__block"]).withColumn("n", (F.col("__before") + F.col("__row") - F.col("__first")).cast("int"))
    text = F.regexp_replace("value", r"^\x{FEFF}", "")
    lines = placed.select(F.substring_index("__file", "/", -1).alias("_source_file"), "n", F.when(F.col("n") == 0, text).otherwise(F.col("value")).alias("line")).where(F.trim("line") != "")
    wanted = T.StructType.fromDDL(schema)
    with_mark = f"{schema}, __bad string"
    parsed = F.from_json("line", with_mark, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    rows = lines.select("_source_file", (F.col("n") + 1).alias("_source_line"), parsed.alias("p"))
    bad = F.col("p").isNull() | F.col("p.__bad").isNotNull()
    return rows.select(*[F.col(f"p.{f.name}").alias(f.name) for f in wanted], bad.alias("_invalid_json"), "_source_file", "_source_line")


def csv(spark: SparkSession, path: str, separator: str = ",", encoding: str = "utf-8", schema: str | None = None) -> DataFrame:
    """A table with a header; all columns are strings unless a schema is given. Quoted values may hold line breaks."""
    reader = spark.read.option("header", "true").option("sep", separator).option("encoding", encoding).option("multiLine", "true").option("quote", '"').option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def year_union(spark: SparkSession, paths: list[str], prefix: bool = False) -> DataFrame:
    """Tables of several years as one, ``year`` from each file's name: its whole stem, or what stands before the first underscore."""
    out = None
    for p in paths:
        stem = p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
        df = spark.read.parquet(p).withColumn("year", F.lit(stem.split("_")[0] if prefix else stem))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError("no paths")
    return out


def consolidate(frames: list[DataFrame], legacy: dict[str, str], id_column: str = "id") -> DataFrame:
    """Tables with old and new headers as one, ids in NFC, with date, number and legislature that the id spells."""
    from acequia.operators.dedup import stack
    from acequia.operators.projection import rename_by

    @F.pandas_udf("string")
    def nfc(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    df = stack(*[rename_by(f, legacy) for f in frames]).withColumn(id_column, nfc(F.col(id_column).cast("string")))
    i = F.col(id_column)
    part = lambda p: F.nullif(F.regexp_extract(i, p, 1), F.lit(""))
    return df.withColumns({"date": F.try_to_date(part(r"(\d{4}-\d{2}-\d{2})"), "yyyy-MM-dd"), "number": part(r"(?i)(?:^|[_-])n(?:um)?[._-]?(\d{1,4})(?:[_.-]|$)"), "legislature": part(r"(?i)(?:^|[_-])l(?:eg)?[._-]?(\d{1,2}|[ivxl]+)(?:[_.-]|$)")})


def wide_answers(df: DataFrame, item: str, pattern: str) -> DataFrame:
    """(item, annotator, answer): columns whose header matches, turned into rows; the annotator is the pattern's first group."""
    import re

    found = {c: m.group(1) for c in df.columns if (m := re.search(pattern, c))}
    if not found:
        raise ValueError(f"no header matches {pattern}")
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("annotator"), F.col(f"`{c}`").cast("string").alias("answer")) for c, a in found.items()]))
    return df.select(F.col(item).alias("item"), cells.alias("r")).select("item", "r.*").where(F.trim("answer") != "")


def sharded(df: DataFrame, order: list[str], workers: int) -> DataFrame:
    """``df`` with the shard of each row: rows in a total order are dealt to the workers in turn."""
    from acequia.operators.ordering import position

    return position(df, order, "__at").withColumn("shard", (F.col("__at") % workers).cast("int")).drop("__at")


def xlsx(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """(file, row, cells) of the sheets of that number in all workbooks of a path: cells by column letter, as text, rows from 1.

    A workbook is read whole, by one task; they are the work of people and small.
    """
    import io
    import re
    import zipfile
    from xml.etree import ElementTree

    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def rows_of(data: bytes) -> list[tuple[int, dict[str, str]]]:
        with zipfile.ZipFile(io.BytesIO(data)) as book:
            shared = []
            if "xl/sharedStrings.xml" in book.namelist():
                shared = ["".join(t.text or "" for t in si.iter(f"{space}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{space}si")]
            out = []
            for row in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{space}row"):
                cells = {}
                for c in row.iter(f"{space}c"):
                    v = c.find(f"{space}v")
                    said = "".join(t.text or "" for t in c.iter(f"{space}t")) if c.get("t") == "inlineStr" else None if v is None else v.text
                    if said is not None:
                        cells[re.sub(r"\d", "", c.get("r", ""))] = shared[int(said)] if c.get("t") == "s" else said
                out.append((int(row.get("r", len(out) + 1)), cells))
            return out

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            yield pd.DataFrame([(f, r, cells) for f, data in zip(batch["path"], batch["content"]) for r, cells in rows_of(data)], columns=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, row int, cells map<string, string>")


def form_answers(spark: SparkSession, path: str, item_header: str, pattern: str, sheet: int = 1) -> DataFrame:
    """(file, item, annotator, answer): answers of forms in workbooks, columns chosen by their header in the first row.

    The column under ``item_header`` names the item; those whose header
    matches hold answers, the annotator is the pattern's first group.
    """
    cells = xlsx(spark, path, sheet)
    flat = cells.select("file", "row", F.explode("cells").alias("letter", "value"))
    heads = flat.where("row = 1").select("file", "letter", F.trim("value").alias("head"))
    body = flat.where("row > 1").join(heads, ["file", "letter"])
    items = body.where(F.col("head") == item_header).select("file", "row", F.col("value").alias("item"))
    answers = body.where(F.col("head").rlike(pattern)).select("file", "row", F.regexp_extract("head", pattern, 1).alias("annotator"), F.col("value").alias("answer"))
    return answers.where(F.trim("answer") != "").join(items, ["file", "row"]).select("file", "item", "annotator", "answer")
