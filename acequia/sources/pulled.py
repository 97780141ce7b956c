"""Sources that are asked page by page or node by node, through a function that is given."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.session import discard, materialize


def paged(keys: DataFrame, key: str, fetch: Callable[[str, str | None], tuple[list[str], str | None]], tries: int = 3, most: int = 1_000_000) -> DataFrame:
    """(key, page, item) of every key: pages are fetched one after another until one has no next token.

    ``fetch(key, token)`` gives a page's items and the next page's token. A
    page that fails ``tries`` times raises; more than ``most`` pages do too,
    for then the tokens run in a circle. Keys are asked side by side.
    """
    kind = keys.schema[key].dataType.simpleString()

    def pages(k):  # noqa: ANN001, ANN202
        token, page = None, 0
        while True:
            for left in range(tries - 1, -1, -1):
                try:
                    items, token = fetch(k, token)
                    break
                except Exception:
                    if not left:
                        raise
            yield from ((k, page, item) for item in items)
            page += 1
            if token is None:
                return
            if page >= most:
                raise RuntimeError(f"{k}: more than {most} pages")

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            yield pd.DataFrame([row for k in batch[key] for row in pages(k)], columns=[key, "page", "item"])

    return keys.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, f"`{key}` {kind}, page int, item string")


def crawl(roots: DataFrame, node: str, fetch: Callable[[str], tuple[list[str], list[str]]], depth: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, items) reached from the roots in ``depth`` steps at most: nodes are (node, depth), items (node, item).

    ``fetch(node)`` gives a node's children and items. Every node is asked
    once, at its least depth, however many lead to it, so circles end. Each
    step asks all new nodes side by side and is written before the next.
    """

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            rows = []
            for n in batch["node"]:
                children, items = fetch(n)
                rows += [(n, c, None) for c in children] + [(n, None, i) for i in items]
            yield pd.DataFrame(rows, columns=["node", "child", "item"])

    new = roots.select(F.col(node).cast("string").alias("node")).where("node is not null").distinct().withColumn("depth", F.lit(0))
    seen = materialize(new, "crawl-seen")
    new, items = seen, None
    for step in range(depth + 1):
        found = materialize(new.select("node").mapInPandas(run, "node string, child string, item string"), "crawl-step")
        part = found.where("item is not null").select("node", "item").distinct()
        items = part if items is None else items.unionByName(part)
        if step == depth:
            break
        new = found.where("child is not null").select(F.col("child").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(step + 1))
        new = materialize(new, "crawl-new")
        if not new.limit(1).count():
            break
        seen, before = materialize(seen.unionByName(new), "crawl-seen"), seen
        if step:
            discard(before)
    return seen, items
