"""Words, tokens and small Arrow helpers shared by the operators."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Token of the corpus: a run of letters, digits and underscores, or one other visible character.
TOKEN_JVM = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x{85}]"
TOKEN = re.compile(r"\w+|[^\w\s]")
WORD = re.compile(r"[^\W_]+")

_marks = [chr(c) for c in range(0x300, 0x10000) if unicodedata.category(chr(c)) == "Mn"]
_MARK = re.compile("[" + "".join(_marks) + "]+")


def fold(text: str) -> str:
    """Lower case without diacritics."""
    text = text.lower()
    if text.isascii():
        return text
    return _MARK.sub("", unicodedata.normalize("NFD", text))


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the folded text; of a null, none."""
    return WORD.findall(fold(text)) if text else []


def source_name(column: str | Column) -> Column:
    """Lower case and trimmed; null becomes ``unknown``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(F.trim(c)), F.lit("unknown"))


def token_count(column: str | Column) -> Column:
    """Tokens of a text, counted in the JVM; 0 of a null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN_JVM)), F.lit(0)).cast("bigint")


def not_blank(column: str | Column) -> Column:
    """Whether a text has any visible character; false of a null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.rlike(r"[^\s\p{Z}\x{200b}\x{feff}]"), F.lit(False))


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Run ``fn`` over Arrow batches: lists by column in, lists or Arrow arrays by column out."""

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch.to_pydict())
            yield pa.RecordBatch.from_arrays(
                [out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)
