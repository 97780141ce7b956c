from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from acequia.llm import neardup

from test_overlap import corpus, share

PREF = "sample_id bigint, prompt string, chosen string, id string, text string, a string"


def found(df):
    return {(r.id_a, r.id_b) for r in neardup.near_pairs(df, "sample_id", ["prompt", "chosen"]).collect()}


def test_near_pairs_are_all_found(spark):
    texts = corpus(300, 2)
    rows = [(i, t.split(" ", 2)[0], t.split(" ", 1)[1], "x", "x", "x") for i, t in enumerate(texts)]
    joined = [f"{r[1]}\n{r[2]}" for r in rows]
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if share(joined[i], joined[j]) >= 0.8}
    df = spark.createDataFrame(rows + rows[:10], PREF)
    got = found(df)
    assert got == want and len(want) > 40


def test_near_pairs_that_differ_in_rare_words(spark):
    """90 of 92 common words stand in 40 % of the records, and 8 rare ones are exchanged: overlap 92/108."""
    rng = random.Random(4)
    everywhere = [f"c{i}" for i in range(225)]
    rows, want = [], set()
    for i in range(400):
        common = rng.sample(everywhere, 90) + [f"r{i}a", f"r{i}b"]
        rows.append((i, "p", " ".join(common + [f"x{i}n{k}" for k in range(8)]), "", "", ""))
        if i < 30:
            rows.append((1000 + i, "p", " ".join(common + [f"y{i}n{k}" for k in range(8)]), "", "", ""))
            want.add((i, 1000 + i))
    df = spark.createDataFrame(rows, PREF)
    assert found(df) == want


def templates(number, records):
    """Records of some templates: 90 words of the template, 10 of their own; every two of one template overlap by 90/110."""
    return [(t * records + i, f"t{t}", " ".join([f"t{t}w{k}" for k in range(89)] + [f"t{t}i{i}n{k}" for k in range(10)]), "", "", "") for t in range(number) for i in range(records)]


def test_records_of_templates_are_all_found(spark):
    df = spark.createDataFrame(templates(10, 400), PREF)
    assert neardup.near_pairs(df, "sample_id", ["prompt", "chosen"]).count() >= 0.999 * 10 * 400 * 399 / 2


def test_hot_keys_are_cut_into_blocks(spark, monkeypatch):
    df = spark.createDataFrame(templates(2, 60) + [(1000 + i, "other", f"text{i} of its own", "", "", "") for i in range(20)], PREF)
    whole = found(df)
    monkeypatch.setattr(neardup, "HOT", 16)
    assert neardup.hot_keys(neardup.signatures(neardup.records(df, "sample_id", ["prompt", "chosen"]))).count() > 0
    assert found(df) == whole and len(whole) == 2 * 60 * 59 / 2


def test_minima_are_those_of_all_elements():
    rng = np.random.default_rng(3)
    sizes = np.array([3, 0, 5000, 40, 1, 2049, 600])
    e = rng.integers(0, 2**63, sizes.sum(), dtype=np.uint64)
    functions = neardup.Permutations(12)
    got = functions.minima(e, sizes)
    at = np.cumsum(sizes) - sizes
    for i, n in enumerate(sizes):
        want = functions.table(e[at[i] : at[i] + n]).min(axis=0) if n else np.full(12, 0xFFFFFFFF)
        assert (got[i] == want).all()


def test_near_pairs_edges(spark):
    t = "el taller de Somtejar empleó cantería en los encargos conocidos " * 30
    rows = [(1, "p", t, "", "", ""), (2, "P", t.upper(), "", "", ""), (3, None, t, "", "", ""), (4, "p", "  ", "", "", ""), (5, "?", "...", "", "", ""), (6, "?", "...", "", "", ""), (None, "p", t, "", "", ""), (7, "p", t + "fin", "", "", "")]
    df = spark.createDataFrame(rows, PREF)
    assert {(r.id_a, r.id_b) for r in neardup.near_pairs(df, "sample_id", ["prompt", "chosen"]).collect()} == {(1, 2), (1, 7), (2, 7)}
    groups = {r.id: (r.rep, r.group_id, r.n_links) for r in neardup.near_groups(df, "sample_id", ["prompt", "chosen"]).collect()}
    assert groups == {1: (1, 1, 1), 2: (1, 1, 1), 7: (7, 1, 1)}
    assert neardup.near_pairs(df.limit(0), "sample_id", ["prompt", "chosen"]).count() == 0
    assert neardup.near_groups(df.limit(0), "sample_id", ["prompt", "chosen"]).count() == 0


def test_estimate_is_corrected_for_chance(spark):
    assert spark.range(1).select(neardup.estimate(F.lit(0), 128), neardup.estimate(F.lit(64), 128)).first()[:] == (1.0, 0.0)
    rng = np.random.default_rng(1)
    common, mine, other = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = (neardup.Permutations(4096).minima(np.concatenate([common, own]), np.array([900]))[0] & 1 for own in (mine, other))
    assert abs(1 - 2 * (x != y).mean() - 0.8) < 0.05
