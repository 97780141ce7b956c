"""Vector search, hard negatives, clusters and projections.

Brute force in blocks: the query set is the bounded side. Queries are read to
the executors in blocks of a size bound, each row of the corpus is scored
against a whole block with one matrix product, and only the k best of a task
leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.measures import normalised

#: Queries held by a task at once.
BLOCK = 4096


def index(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", metric: str = "ip") -> DataFrame:
    """(id, vector), one row by id; vectors at length 1 for inner products."""
    once = df.where(F.col(vector).isNotNull()).groupBy(id_column).agg(F.min(vector).alias("v"))
    v = normalised(F.col("v")) if metric == "ip" else F.transform("v", lambda x: x.cast("double"))
    return once.select(F.col(id_column).alias("id"), v.alias("vector"))


def _blocks(queries: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    ids: list = []
    rows: list = []
    for r in queries.select("id", "vector").toLocalIterator():
        ids.append(r[0])
        rows.append(r[1])
        if len(ids) == BLOCK:
            yield ids, np.array(rows)
            ids, rows = [], []
    if ids:
        yield ids, np.array(rows)


def top_k(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "ip", skip_self: bool = True) -> DataFrame:
    """(query_id, id, score, rank): the k best rows of a corpus for each query, ties in order of id.

    Both are tables of ``index``. Score is the inner product, or the negative
    squared distance for l2. A task keeps k rows a query; the last ranking
    sees k times the number of tasks.
    """
    spark = queries.sparkSession
    kind = queries.schema["id"].dataType.simpleString()
    found = None
    for ids, matrix in _blocks(queries):
        shared = spark.sparkContext.broadcast((ids, matrix))

        def score(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own, q = shared.value
            best: pd.DataFrame | None = None
            for f in frames:
                if not len(f):
                    continue
                x = np.stack(f["vector"].to_numpy())
                s = q @ x.T
                if metric == "l2":
                    s = 2 * s - (q * q).sum(1)[:, None] - (x * x).sum(1)[None, :]
                s = np.round(s, 9)
                there = f["id"].to_numpy()
                if skip_self:
                    place = {v: i for i, v in enumerate(own)}
                    for j, v in enumerate(there):
                        i = place.get(v)
                        if i is not None:
                            s[i, j] = -np.inf
                order = np.lexsort((np.broadcast_to(there, s.shape), -s), axis=1)[:, :k]
                part = pd.DataFrame({"query_id": np.repeat(own, order.shape[1]), "id": there[order].ravel(), "score": np.take_along_axis(s, order, 1).ravel()})
                best = part if best is None else pd.concat([best, part])
                best = best.sort_values(["query_id", "score", "id"], ascending=[True, False, True]).groupby("query_id").head(k)
            if best is not None:
                yield best[np.isfinite(best["score"])]

        part = corpus.select("id", "vector").mapInPandas(score, f"query_id {kind}, id {kind}, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"query_id {kind}, id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def retrieved(hits: DataFrame) -> DataFrame:
    """(query_id, ids, scores): hits of a query as lists in order of rank."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
    return hits.groupBy("query_id").agg(ordered.alias("h")).select("query_id", F.col("h.id").alias("ids"), F.col("h.score").alias("scores"))


def hard_negatives(hits: DataFrame, positives: DataFrame, *, first: int = 10, last: int = 50, most_score: float = 0.8, margin: float = 0.05, n: int = 5, seed: int | None = None) -> DataFrame:
    """(query_id, id, score, place): up to n hits of each query that are near but not too near.

    Ranks first to last, a score of at most ``most_score`` and at most the
    positive's less a relative margin; the best, or by a seed's hash any.
    positives: (query_id, id, score).
    """
    pos = positives.groupBy("query_id").agg(F.max("score").alias("positive"))
    near = hits.where(F.col("rank").between(first, last - 1) & (F.col("score") <= most_score)).join(pos, "query_id")
    near = near.where(F.col("score") <= F.col("positive") * (1 - margin)).join(positives.select("query_id", "id"), ["query_id", "id"], "left_anti")
    order = [F.desc("score"), F.col("id")] if seed is None else [F.xxhash64(F.lit(seed), "query_id", "id")]
    return near.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("place") <= n).select("query_id", "id", "score", "place")


def spherical_kmeans(df: DataFrame, k: int, vector: str = "vector", seed: int = 42, rounds: int = 20) -> DataFrame:
    """``df`` with ``cluster``, by k-means on directions; zero vectors go to cluster 0."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x)
    features = df.withColumn("__v", array_to_vector(F.col(vector))).withColumn("__zero", n == 0)
    model = KMeans(k=k, seed=seed, maxIter=rounds, distanceMeasure="cosine", featuresCol="__v", predictionCol="cluster").fit(features.where(~F.col("__zero")))
    placed = model.transform(features.where(~F.col("__zero"))).select(*df.columns, "cluster")
    return placed.unionByName(features.where("__zero").select(*df.columns, F.lit(0).alias("cluster")))


def project(df: DataFrame, vector: str = "vector") -> DataFrame:
    """``df`` with x and y, the first two principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    features = df.withColumn("__v", array_to_vector(F.col(vector)))
    out = PCA(k=2, inputCol="__v", outputCol="__p").fit(features).transform(features).withColumn("__a", vector_to_array("__p"))
    return out.select(*df.columns, F.col("__a")[0].alias("x"), F.col("__a")[1].alias("y"))


def diverse(df: DataFrame, n: int, near: int = 4000, weight: float = 0.7, id_column: str = "id", vector: str = "vector") -> DataFrame:
    """(id, place): n rows chosen one by one for nearness to the centroid less likeness to those chosen.

    Only the ``near`` rows nearest to the centroid are candidates, so the
    greedy part sees a bounded number.
    """
    dims = len(df.select(vector).head()[0])
    mean = df.agg(F.array(*[F.avg(F.col(vector)[i]) for i in range(dims)]).alias("m")).head()[0]
    centre = F.array(*[F.lit(float(x)) for x in mean])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = df.select(F.col(id_column).alias("id"), F.col(vector).alias("v"), F.round(dot(F.col(vector), centre) / F.sqrt(dot(centre, centre)), 9).alias("s"))
    candidates = scored.orderBy(F.desc("s"), "id").limit(near).withColumn("g", F.lit(1))
    kind = df.schema[id_column].dataType.simpleString()

    def choose(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["s", "id"], ascending=[False, True]).reset_index(drop=True)
        x, s = np.stack(f["v"].to_numpy()), f["s"].to_numpy()
        like = np.zeros(len(f))
        taken: list[int] = []
        open_ = np.ones(len(f), dtype=bool)
        while len(taken) < min(n, len(f)):
            value = np.where(open_, weight * s - (1 - weight) * like, -np.inf)
            i = int(value.argmax())
            taken.append(i)
            open_[i] = False
            like = np.maximum(like, x @ x[i])
        return pd.DataFrame({"id": f["id"].iloc[taken], "place": range(1, len(taken) + 1)})

    return candidates.groupBy("g").applyInPandas(choose, f"id {kind}, place int")


def resilient(embed: Callable[[list[str]], np.ndarray], tries: int = 2) -> Callable[[list[str | None]], list[list[float] | None]]:
    """An embedder that survives failures of the given one: it tries again, then halves the batch, and leaves a text null that fails alone."""

    def run(texts: list[str | None]) -> list[list[float] | None]:
        there = [i for i, t in enumerate(texts) if t is not None]
        out: list[list[float] | None] = [None] * len(texts)
        stack = [there] if there else []
        while stack:
            part = stack.pop()
            for _ in range(tries):
                try:
                    found = np.asarray(embed([texts[i] for i in part]), dtype=float)
                except Exception:  # noqa: BLE001, whatever the given function raises
                    continue
                for i, v in zip(part, found):
                    out[i] = v.tolist()
                break
            else:
                if len(part) > 1:
                    stack += [part[len(part) // 2 :], part[: len(part) // 2]]
        return out

    return run


def embedded(df: DataFrame, embed: Callable[[list[str]], np.ndarray], text: str = "text", name: str = "vector", tries: int = 2, batch: int = 256) -> DataFrame:
    """``df`` with the vector of a text by a given function, in batches; null of a null text and of one that fails alone."""
    safe = resilient(embed, tries)

    @F.pandas_udf("array<double>")
    def column(c: pd.Series) -> pd.Series:
        texts = c.where(c.notna(), None).tolist()
        return pd.Series([v for k in range(0, len(texts), batch) for v in safe(texts[k : k + batch])], index=c.index, dtype=object)

    return df.withColumn(name, column(F.col(text)))


def feature_classifier(df: DataFrame, label: str, numbers: list[str], vector: str, components: int = 2, layers: tuple[int, ...] = (16,), seed: int = 42, rounds: int = 100):  # noqa: ANN201
    """A fitted pipeline: numbers, a vector and its principal components as features of a perceptron with hidden layers.

    Rows whose label is null are left out of the fit; null numbers and
    vectors have to be filled before. ``transform`` gives ``prediction``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import array_to_vector

    known = df.where(F.col(label).isNotNull())
    size = len(known.select(vector).head()[0])
    classes = int(known.agg(F.max(label)).first()[0]) + 1
    features = known.withColumn("__v", array_to_vector(F.col(vector).cast("array<double>"))).withColumn(label, F.col(label).cast("double"))
    stages = [
        PCA(k=components, inputCol="__v", outputCol="__pca"),
        VectorAssembler(inputCols=[*numbers, "__v", "__pca"], outputCol="__all"),
        StandardScaler(inputCol="__all", outputCol="__scaled", withMean=True),
        MultilayerPerceptronClassifier(layers=[len(numbers) + size + components, *layers, classes], labelCol=label, featuresCol="__scaled", seed=seed, maxIter=rounds),
    ]
    return Pipeline(stages=stages).fit(features)


def classified(df: DataFrame, model, vector: str) -> DataFrame:  # noqa: ANN001
    """``df`` with ``prediction`` by a model of feature_classifier."""
    from pyspark.ml.functions import array_to_vector

    return model.transform(df.withColumn("__v", array_to_vector(F.col(vector).cast("array<double>")))).select(*df.columns, F.col("prediction").cast("int").alias("prediction"))
