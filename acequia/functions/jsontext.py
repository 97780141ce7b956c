"""JSON that models wrote: lenient parsing, balancing, verdicts and flags."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIR = re.compile(r'"([\w-]+)"\s*:\s*("(?:[^"\\]|\\.)*"|-?\d+(?:\.\d+)?|true|false|null)')


def balance(text: str) -> str:
    """Close what a cut-off JSON text leaves open: string, brackets and braces."""
    open_: list[str] = []
    quoted = escaped = False
    for c in text:
        if quoted:
            quoted, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]" and open_ and open_[-1] == c:
            open_.pop()
    text = (text[:-1] if escaped else text) + '"' * quoted
    text = re.sub(r'[,:]\s*$|,\s*"[^"]*"\s*$' if open_ and open_[-1] == "}" else r",\s*$", "", text.rstrip())
    return text + "".join(reversed(open_))


def repair(text: str | None) -> str | None:
    """The JSON object in a text, as compact JSON: as it stands, between its outer braces, balanced, or pair by pair."""
    if not text:
        return None
    start, end = text.find("{"), text.rfind("}")
    tries = [text, text[start : end + 1] if 0 <= start < end else "", balance(text[start:]) if start >= 0 else ""]
    for t in tries:
        try:
            value = json.loads(t)
        except ValueError:
            continue
        if isinstance(value, dict):
            return json.dumps(value, ensure_ascii=False, sort_keys=True)
    pairs = {k: json.loads(v) for k, v in _PAIR.findall(text)}
    return json.dumps(pairs, ensure_ascii=False, sort_keys=True) if pairs else None


@F.pandas_udf(T.StringType())
def repaired(c: pd.Series) -> pd.Series:
    return c.map(repair)


def flag(c: Column) -> Column:
    """1 of true, yes, y and 1; 0 of false, no, n and 0; else null."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "yes", "y", "1"), 1).when(t.isin("false", "no", "n", "0"), 0)


def verdict(c: Column) -> Column:
    """(winner, confidence, reason) of a judge's answer: from its outer JSON object, or else from its words with confidence 5."""
    outer = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    parsed = F.from_json(F.when(outer != "", outer), "winner string, confidence int, reason string")
    said = F.upper(F.regexp_extract(c, r"(?i)\b(?:winner|ganador|mejor)\W+(?:es |is |respuesta |answer )*\"?([AB])\b", 1))
    return F.when(
        parsed["winner"].isNotNull(), F.struct(F.upper(parsed["winner"]).alias("winner"), F.coalesce(parsed["confidence"], F.lit(5)).alias("confidence"), parsed["reason"].alias("reason"))
    ).when(said != "", F.struct(said.alias("winner"), F.lit(5).alias("confidence"), F.lit(None).cast("string").alias("reason")))


def canonical_key(*columns: Column) -> Column:
    """A cache key: SHA-256 of the values as JSON in the order given."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def missing_fields(**columns: Column) -> Column:
    """Names of the fields that are null, or blank texts or empty lists by their SQL type."""
    tests = []
    for name, c in columns.items():
        tests.append(F.when(c.isNull() | (F.trim(c.cast("string")).isin("", "[]")), F.lit(name)))
    return F.array_compact(F.array(*tests))


def field_errors(bounds: dict[str, tuple[int | None, int | None]]) -> Column:
    """What is wrong with text fields of a schema: missing, short or long, by the least and most characters of each; None is no bound."""
    tests = []
    for name, (least, most) in bounds.items():
        c = F.col(name)
        test = F.when(c.isNull(), F.lit(f"{name}_missing"))
        if least is not None:
            test = test.when(F.length(c) < least, F.lit(f"{name}_short"))
        if most is not None:
            test = test.when(F.length(c) > most, F.lit(f"{name}_long"))
        tests.append(test)
    return F.array_compact(F.array(*tests))
