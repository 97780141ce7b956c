"""Problem 3: one ranking from pairwise comparisons.

Strengths are the weighted least squares solution on the comparison graph:
log-odds margins as edge values, the information of each edge as weight. The
normal equations are a Laplacian system, solved by conjugate gradient. Margin
and weight are worked out anew at each solution until they agree with it, so
that the strengths explain all results together (the fixed point is the
maximum of the Bradley-Terry likelihood); one-sided results then need no
smoothing to count in full.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.operators.ordering import position
from acequia.session import discard, materialize

#: Edges (pairs of items that met) up to which the vectors are arrays in one place; beyond, they are tables and every product is a Spark job.
EDGES_IN_MEMORY = 2_000_000
#: Pull on every strength towards 0. Residual of a linear system, to its right side, and change of a strength, at which the
#: iterations end; and how many there may be. The same in both ways; one that doesn't get there raises an error.
RIDGE, RESIDUAL, CHANGE = 1e-3, 1e-9, 1e-8
INNER, ROUNDS = 10_000, 100
#: Digits of a strength that tell places apart; what the iterations leave open lies beyond.
DIGITS = 6


class NotConverged(RuntimeError):
    """The iterations came to their end before the strengths stood still."""


def comparisons(rows: DataFrame, winner: Column, loser: Column) -> DataFrame:
    """(a, b, wins_a, wins_b) with a < b: results by pair of items, names lower case and trimmed.

    Rows with a null or empty name, or the same name twice, don't count.
    """
    w, l = F.lower(F.trim(winner)), F.lower(F.trim(loser))
    first = F.least("w", "l")
    return (
        rows.select(w.alias("w"), l.alias("l"))
        .where("w <> '' and l <> '' and w <> l")
        .groupBy(first.alias("a"), F.greatest("w", "l").alias("b"))
        .agg(F.sum((F.col("w") == first).cast("double")).alias("wins_a"), F.sum((F.col("w") != first).cast("double")).alias("wins_b"))
    )


def conjugate_gradient(product, rhs: np.ndarray, x: np.ndarray, tolerance: float = RESIDUAL, most: int = INNER) -> np.ndarray:
    """Solution of a positive definite system given by its product with a vector; NotConverged without one after ``most`` steps."""
    r = rhs - product(x)
    p = r.copy()
    rr = float(r @ r)
    goal = tolerance * tolerance * max(float(rhs @ rhs), 1e-30)
    for k in range(most + 1):
        if rr <= goal:
            break
        if k == most:
            raise NotConverged(f"residual {rr**0.5} after {most} steps")
        q = product(p)
        step = rr / float(p @ q)
        x = x + step * p
        r = r - step * q
        rr, before = float(r @ r), rr
        p = r + (rr / before) * p
    return x


def _working(wa, wb, margin, lib):
    """Weight and working margin of an edge at the current difference of strengths."""
    p = 1.0 / (1.0 + lib.exp(-margin))
    n = wa + wb
    weight = n * p * (1.0 - p)
    return weight, weight * margin + wa - n * p


def solve(a: np.ndarray, b: np.ndarray, wins_a: np.ndarray, wins_b: np.ndarray, n: int, ridge: float = RIDGE, rounds: int = ROUNDS) -> np.ndarray:
    """Strengths of n items, mean 0.

    ``ridge`` keeps items that won or lost every comparison, and parts of the
    graph that never met, at finite strengths; it is far below the weight of
    one comparison.
    """
    x = np.zeros(n)
    for _ in range(rounds):
        weight, pull = _working(wins_a, wins_b, np.clip(x[a] - x[b], -30, 30), np)

        def product(v: np.ndarray, weight=weight) -> np.ndarray:
            flow = weight * (v[a] - v[b])
            return np.bincount(a, flow, n) - np.bincount(b, flow, n) + ridge * v

        rhs = np.bincount(a, pull, n) - np.bincount(b, pull, n)
        new = conjugate_gradient(product, rhs, x)
        step = new - x
        big = float(np.abs(step).max(initial=0.0))
        x = x + step * min(1.0, 3.0 / max(big, 1e-12))
        if big < CHANGE:
            return x - x.mean() if n else x
    raise NotConverged(f"a strength still moves by {big} after {rounds} rounds")


def _spread(edges: DataFrame, v: DataFrame) -> DataFrame:
    """Edges with the values of both ends."""
    va, vb = v.toDF("a", "va"), v.toDF("b", "vb")
    return edges.join(va, "a").join(vb, "b")


def _ends(edges: DataFrame, flow: str) -> DataFrame:
    """Sum of a flow over the edges of each item: into a, out of b."""
    both = F.explode(F.array(F.struct(F.col("a").alias("item"), F.col(flow).alias("f")), F.struct(F.col("b").alias("item"), (-F.col(flow)).alias("f"))))
    return edges.select(both.alias("e")).groupBy("e.item").agg(F.sum("e.f").alias("f"))


def solve_distributed(edges: DataFrame, ridge: float = RIDGE, rounds: int = ROUNDS, inner: int = INNER, tolerance: float = RESIDUAL) -> DataFrame:
    """(item, strength): as ``solve``, with every vector a table and every product a join and an aggregate.

    Vectors are written to the checkpoint folder at each step, which cuts the
    lineage; those of the step before are deleted.
    """
    items = edges.select(F.explode(F.array("a", "b")).alias("item")).distinct()
    x = materialize(items.withColumn("x", F.lit(0.0)), "cg-x")
    for _ in range(rounds):
        at = _spread(edges, x).withColumn("margin", F.greatest(F.least(F.col("va") - F.col("vb"), F.lit(30.0)), F.lit(-30.0)))
        weight, pull = _working(F.col("wins_a"), F.col("wins_b"), F.col("margin"), F)
        system = materialize(at.select("a", "b", weight.alias("weight"), pull.alias("pull")), "cg-edges")
        rhs = _ends(system, "pull")

        def product(v: DataFrame, system=system) -> DataFrame:
            flow = _spread(system, v).select("a", "b", (F.col("weight") * (F.col("va") - F.col("vb"))).alias("flow"))
            return v.toDF("item", "v").join(_ends(flow, "flow"), "item").select("item", (F.col("f") + ridge * F.col("v")).alias("q"))

        start = x.join(rhs, "item").join(product(x), "item").select("item", "x", (F.col("f") - F.col("q")).alias("r"))
        state = materialize(start.withColumn("p", F.col("r")), "cg-state")
        rr = state.agg(F.sum(F.col("r") * F.col("r"))).first()[0] or 0.0
        goal = tolerance * tolerance * max(rhs.agg(F.sum(F.col("f") * F.col("f"))).first()[0] or 0.0, 1e-30)
        for k in range(inner + 1):
            if rr <= goal:
                break
            if k == inner:
                raise NotConverged(f"residual {rr**0.5} after {inner} steps")
            step = materialize(state.join(product(state.select("item", "p")), "item"), "cg-product")
            alpha = rr / step.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
            moved = step.select("item", (F.col("x") + alpha * F.col("p")).alias("x"), (F.col("r") - alpha * F.col("q")).alias("r"), "p")
            new = moved.agg(F.sum(F.col("r") * F.col("r"))).first()[0]
            before, state = state, materialize(moved.select("item", "x", "r", (F.col("r") + (new / rr) * F.col("p")).alias("p")), "cg-state")
            discard(before, step)
            rr = new
        both = x.join(state.select("item", F.col("x").alias("new")), "item")
        big = both.agg(F.max(F.abs(F.col("new") - F.col("x")))).first()[0] or 0.0
        scale = min(1.0, 3.0 / max(big, 1e-12))
        before, x = x, materialize(both.select("item", (F.col("x") + scale * (F.col("new") - F.col("x"))).alias("x")), "cg-x")
        discard(before, state, system)
        if big < CHANGE:
            mean = x.agg(F.avg("x")).first()[0] or 0.0
            return x.select("item", (F.col("x") - mean).alias("strength"))
    raise NotConverged(f"a strength still moves by {big} after {rounds} rounds")


def strengths(edges: DataFrame, edges_in_memory: int = EDGES_IN_MEMORY) -> DataFrame:
    """(item, strength) of the items of a comparison graph.

    The graph has one edge by pair that met, whatever the number of results.
    Up to ``edges_in_memory`` of them the vectors are arrays in one place;
    with more they are tables. Both ways take the same steps to the same
    tolerances.
    """
    edges = materialize(edges, "edges")
    if edges.count() > edges_in_memory:
        return solve_distributed(edges)
    rows = edges.toArrow().to_pandas().sort_values(["a", "b"])
    names = sorted(set(rows["a"]) | set(rows["b"]))
    index = {x: i for i, x in enumerate(names)}
    x = solve(
        rows["a"].map(index).to_numpy(dtype=np.int64),
        rows["b"].map(index).to_numpy(dtype=np.int64),
        rows["wins_a"].to_numpy(dtype=float),
        rows["wins_b"].to_numpy(dtype=float),
        len(names),
    )
    return edges.sparkSession.createDataFrame(list(zip(names, x.tolist())), "item string, strength double")


def ranking(edges: DataFrame, **options: int) -> DataFrame:
    """(item, rank_no, strength, n, wins): one place for each item, 1 the strongest; ties in order of name.

    Empty without comparisons.
    """
    edges = materialize(edges, "edges")
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("item"), F.col("wins_a").alias("w"), (F.col("wins_a") + F.col("wins_b")).alias("n")),
            F.struct(F.col("b").alias("item"), F.col("wins_b").alias("w"), (F.col("wins_a") + F.col("wins_b")).alias("n")),
        )
    )
    totals = edges.select(ends.alias("e")).groupBy("e.item").agg(F.sum("e.n").cast("bigint").alias("n"), F.sum("e.w").cast("bigint").alias("wins"))
    placed = position(strengths(edges, **options).withColumn("weak", -F.round("strength", DIGITS)), ["weak", "item"], "rank_no")
    return placed.join(totals, "item").select("item", (F.col("rank_no") + 1).alias("rank_no"), "strength", "n", "wins")


def residuals(edges: DataFrame, **options: int) -> DataFrame:
    """(a, b, n, margin, fitted, residual, weight, energy): what one order can't explain of each pair's results.

    Of the system that was solved: ``margin`` is the log-odds margin of the
    pair at the solution, ``fitted`` the difference of strengths, ``weight``
    the information of the pair, ``residual`` what is left of the margin, the
    cyclic part, and ``energy`` its weighted square.
    """
    edges = materialize(edges, "edges")
    at = _spread(edges, strengths(edges, **options)).withColumn("fitted", F.col("va") - F.col("vb"))
    weight, pull = _working(F.col("wins_a"), F.col("wins_b"), F.col("fitted"), F)
    left = F.col("margin") - F.col("fitted")
    return at.select("a", "b", (F.col("wins_a") + F.col("wins_b")).cast("bigint").alias("n"), weight.alias("weight"), (pull / weight).alias("margin"), "fitted").select(
        "a", "b", "n", "margin", "fitted", left.alias("residual"), "weight", (F.col("weight") * left * left).alias("energy")
    )


def inconsistency(left: DataFrame) -> DataFrame:
    """(n, energy, norm, share) of residuals: pairs, weighted energy no order explains, its root, and its share of the energy of all margins.

    0 everywhere without a pair; a share of 0 says that one order explains every result.
    """
    whole = F.sum(F.col("weight") * F.col("margin") * F.col("margin"))
    energy = F.coalesce(F.sum("energy"), F.lit(0.0))
    return left.agg(F.count("*").alias("n"), energy.alias("energy"), F.sqrt(energy).alias("norm"), F.when(whole > 0, energy / whole).otherwise(F.lit(0.0)).alias("share"))


def balance(edges: DataFrame, **options: int) -> DataFrame:
    """(item, n, wins, expected_wins): wins of each item, and those its strength leads to expect; equal where strengths explain all results together."""
    edges = materialize(edges, "edges")
    at = _spread(edges, strengths(edges, **options))
    n, p = F.col("wins_a") + F.col("wins_b"), 1.0 / (1.0 + F.exp(F.col("vb") - F.col("va")))
    ends = F.array(F.struct(F.col("a").alias("item"), n.alias("n"), F.col("wins_a").alias("w"), (n * p).alias("e")), F.struct(F.col("b").alias("item"), n.alias("n"), F.col("wins_b").alias("w"), (n * (1.0 - p)).alias("e")))
    return at.select(F.explode(ends).alias("e")).groupBy("e.item").agg(F.sum("e.n").cast("bigint").alias("n"), F.sum("e.w").cast("bigint").alias("wins"), F.sum("e.e").alias("expected_wins"))


def judged(preferences: DataFrame) -> DataFrame:
    """Comparison graph of judged answers: rows with both models, different ones, and a confidence of 1 to 10."""
    counted = preferences.where(F.col("metadata.confidence").between(1, 10))
    return comparisons(counted, F.col("metadata.model_chosen"), F.col("metadata.model_rejected"))
