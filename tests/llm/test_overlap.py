from __future__ import annotations

import random
from collections import Counter

from acequia.llm import overlap
from acequia.llm.text import words


def share(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    both = sum((x & y).values())
    return both / max(1, x.total() + y.total() - both)


def corpus(n, seed):
    """Texts of which half are edits of earlier ones: words left out, put in, doubled or moved."""
    rng = random.Random(seed)
    names = [a + b for a in "ba ce di fo gu la me ni po ru sa te".split() for b in "ta vel gor min dra sil pen".split()]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.5:
            w = rng.choice(out).split()
            for _ in range(rng.randrange(len(w) // 4 + 2)):
                at, what = rng.randrange(len(w)), rng.randrange(4)
                if what == 0 and len(w) > 3:
                    del w[at]
                elif what == 1:
                    w.insert(at, rng.choice(names))
                elif what == 2:
                    w.insert(at, w[at])
                else:
                    w.append(w.pop(at))
        else:
            w = [rng.choice(names) if rng.random() < 0.6 else rng.choice("el de la en y".split()) for _ in range(rng.randrange(8, 40))]
        out.append(" ".join(w))
    return out


PAIR = "pair_id bigint, split_name string, source_id string, id string, text_es string, text_en string, part int, n int"


def test_cross_split_is_exact(spark):
    es, en = corpus(260, 1), corpus(260, 1)
    rng = random.Random(5)
    rows = [(i, rng.choice(["train"] * 3 + ["validation", "test", None]), "S", "x", es[i], en[i], 1, 1) for i in range(len(es))]
    want = {(a[0], b[0]) for a in rows if a[1] == "train" for b in rows if b[1] in ("validation", "test") and share(a[4], b[4]) >= 0.8 and share(a[5], b[5]) >= 0.8}
    got = overlap.cross_split_pairs(spark.createDataFrame(rows + rows[:20], PAIR))
    assert {(r.id_one, r.id_other) for r in got.collect()} == want
    assert len(want) > 20


def test_long_lists_in_blocks(spark, monkeypatch):
    es = corpus(120, 3)
    df = spark.createDataFrame([(i, "test" if i % 3 == 0 else "train", "S", "x", t, t, 1, 1) for i, t in enumerate(es)], PAIR)
    whole = {tuple(r) for r in overlap.cross_split_pairs(df).collect()}
    monkeypatch.setattr(overlap, "HOT", 3)
    assert {tuple(r) for r in overlap.cross_split_pairs(df).collect()} == whole and len(whole) > 10


def test_cross_split_edges(spark):
    t = "el taller de Somtejar empleó cantería en los encargos conocidos"
    rows = [
        (1, "train", "A ", None, t, t, 1, 1), (2, "test", "a", None, "- " + t.upper(), t + "\n", 1, 1), (3, "test", "A", "", None, t, 1, 1), (4, "validation", "A", "", t, " ", 1, 1),
        (5, None, "A", "", t, t, 1, 1), (6, "train", "A", "", t, "otra cosa del todo", 1, 1), (7, "test", "A", "", "...", "...", 1, 1), (8, "train", "A", "", "...", "...", 1, 1), (None, "train", "A", "", t, t, 1, 1),
    ]
    df = spark.createDataFrame(rows, PAIR)
    pairs = overlap.cross_split_pairs(df)
    assert [(r.id_one, r.id_other) for r in pairs.collect()] == [(1, 2)]
    report = {(r.split, r.source): (r.n_records, r.n_overlapping) for r in overlap.overlap_report(df, pairs).collect()}
    assert report == {("test", "a"): (3, 1), ("validation", "a"): (1, 0)}
    assert overlap.cross_split_pairs(df.limit(0)).count() == 0
