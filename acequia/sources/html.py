"""Text and records of HTML pages, with the standard library's parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SILENT = {"script", "style", "noscript", "template", "head"}


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.silent += tag in _SILENT

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT and self.silent:
            self.silent -= 1

    def handle_data(self, data: str) -> None:
        if not self.silent and data.strip():
            self.parts.append(data.strip())


def html_text(html: str | None) -> str | None:
    """Visible text, parts joined by blanks; null of a null."""
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(p.parts)


@F.pandas_udf(T.StringType())
def html_to_text(c: pd.Series) -> pd.Series:
    return c.map(html_text)


class _Sections(HTMLParser):
    """List items under the headings they stand below."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.heads = {"h3": "", "h4": "", "h5": ""}
        self.tag = ""
        self.text: list[str] = []
        self.rows: list[tuple[str, str, str, str]] = []

    def _end(self) -> None:
        text = " ".join(" ".join(self.text).split())
        if self.tag in self.heads:
            self.heads[self.tag] = text
            for lower in [t for t in self.heads if t > self.tag]:
                self.heads[lower] = ""
        elif self.tag == "li" and text:
            self.rows.append((*self.heads.values(), text))
        self.tag, self.text = "", []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in (*self.heads, "li"):
            self._end()
            self.tag = tag

    def handle_endtag(self, tag: str) -> None:
        if tag == self.tag:
            self._end()

    def handle_data(self, data: str) -> None:
        if self.tag:
            self.text.append(data)


def section_records(df: DataFrame, id_column: str, html: str) -> DataFrame:
    """(id, section, subsection, item_group, item): list items with the h3, h4 and h5 above them."""
    kind = df.schema[id_column].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for i, h in zip(f["id"], f["h"]):
                p = _Sections()
                p.feed(h)
                p.close()
                p._end()
                rows += [(i, *r) for r in p.rows]
            yield pd.DataFrame(rows, columns=["id", "section", "subsection", "item_group", "item"])

    there = df.where(F.col(html).isNotNull()).select(F.col(id_column).alias("id"), F.col(html).alias("h"))
    return there.mapInPandas(run, f"id {kind}, section string, subsection string, item_group string, item string")
