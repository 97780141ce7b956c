from __future__ import annotations

import math
import random

import numpy as np
import pytest

from acequia.llm import ranking

SCHEMA = "sample_id bigint, metadata struct<model_chosen: string, model_rejected: string, judge_reason: string, confidence: int>, item string, w string, l string, a string"


def rows(spark, data):
    return spark.createDataFrame([(i, (w, l, None, c), "x", "x", "x", "x") for i, (w, l, c) in enumerate(data)], SCHEMA)


def bradley_terry(results):
    names = sorted({x for r in results for x in r})
    s = dict.fromkeys(names, 1.0)
    for _ in range(5000):
        new = {}
        for m in names:
            won = sum(1 for w, _ in results if w == m)
            met = sum(1 / (s[w] + s[l]) for w, l in results if m in (w, l))
            new[m] = won / met
        scale = math.exp(sum(map(math.log, new.values())) / len(names))
        s = {m: v / scale for m, v in new.items()}
    return {m: math.log(v) for m, v in s.items()}


@pytest.fixture(scope="module")
def results():
    rng = random.Random(3)
    true = {f"m{i}": 1.5 - 0.7 * i for i in range(5)}
    out = []
    for _ in range(600):
        a, b = rng.sample(sorted(true), 2)
        out.append((a, b) if rng.random() < 1 / (1 + math.exp(true[b] - true[a])) else (b, a))
    return out


def test_agrees_with_the_likelihood(spark, results):
    got = {r.item: r.strength for r in ranking.strengths(ranking.judged(rows(spark, [(w, l, 5) for w, l in results]))).collect()}
    for m, x in bradley_terry(results).items():
        assert got[m] == pytest.approx(x, abs=0.02)


def test_tables_agree_with_memory(spark, results):
    edges = ranking.judged(rows(spark, [(w, l, 5) for w, l in results[:80]]))
    here = {r.item: r.strength for r in ranking.strengths(edges).collect()}
    there = {r.item: r.strength for r in ranking.strengths(edges, edges_in_memory=0).collect()}
    assert set(here) == set(there)
    for m, x in here.items():
        assert there[m] == pytest.approx(x, abs=1e-6)


def test_no_silent_end(spark):
    a, b, w = np.array([0, 1]), np.array([1, 2]), np.array([9.0, 9.0])
    with pytest.raises(ranking.NotConverged):
        ranking.solve(a, b, w, np.zeros(2), 3, rounds=2)
    with pytest.raises(ranking.NotConverged):
        ranking.conjugate_gradient(lambda v: np.array([[4.0, 1.0], [1.0, 3.0]]) @ v, np.array([1.0, 2.0]), np.zeros(2), most=1)


def test_expected_wins_are_the_wins(spark, results):
    for r in ranking.balance(ranking.judged(rows(spark, [(w, l, 5) for w, l in results]))).collect():
        assert r.expected_wins == pytest.approx(r.wins, abs=0.01)


def test_what_counts(spark):
    data = [(" A", "b", 5), ("a", "B ", 10), ("b", "a", 0), ("b", "a", 11), ("b", "a", None), ("b", None, 5), ("", "a", 5), ("a", "A", 5), ("b", "c", 1)]
    out = [(r.item, r.rank_no, r.n, r.wins) for r in ranking.ranking(ranking.judged(rows(spark, data))).orderBy("rank_no").collect()]
    assert out == [("a", 1, 2, 2), ("b", 2, 3, 1), ("c", 3, 1, 0)]
    assert ranking.ranking(ranking.judged(rows(spark, []))).count() == 0


def test_ties_go_by_name(spark):
    out = ranking.ranking(ranking.judged(rows(spark, [("z", "y", 5), ("y", "z", 5)]))).orderBy("rank_no").collect()
    assert [r.item for r in out] == ["y", "z"]


def test_cycle_is_a_residual(spark):
    data = [("a", "b", 5)] * 9 + [("b", "c", 5)] * 9 + [("c", "a", 5)] * 9
    out = ranking.residuals(ranking.judged(rows(spark, data))).collect()
    assert all(abs(r.fitted) < 1e-6 and abs(r.residual) == pytest.approx(2) for r in out)
    total = ranking.inconsistency(ranking.residuals(ranking.judged(rows(spark, data)))).first()
    assert total.n == 3 and total.share == pytest.approx(1) and total.energy == pytest.approx(sum(r.energy for r in out))
    assert ranking.inconsistency(ranking.residuals(ranking.judged(rows(spark, [])))).first()[:] == (0, 0.0, 0.0, 0.0)


def test_conjugate_gradient():
    m = np.array([[4.0, 1.0, 0.0], [1.0, 3.0, 0.5], [0.0, 0.5, 2.0]])
    x = ranking.conjugate_gradient(lambda v: m @ v, np.array([1.0, 2.0, 3.0]), np.zeros(3))
    assert np.allclose(m @ x, [1, 2, 3])
