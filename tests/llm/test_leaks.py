from __future__ import annotations

import random

from acequia.llm import leaks
from acequia.llm.leaks import PassageAutomaton, find_leaks, passage_words, remove_leaks

DOC = "doc_id bigint, text string, item_id string, n_words string, coverage string"
ITEM = "item_id bigint, passage string, doc_id string, text string"
P = "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce"


def test_words():
    assert passage_words("El molí-\nnero  Ñandú—dos") == ["el", "molinero", "nandu", "dos"]
    assert passage_words("re­mite") == ["remite"]
    assert passage_words(None) == []


def test_automaton_matches_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        passages = [[rng.choice("abc") for _ in range(rng.randrange(1, 25))] for _ in range(5)]
        text = [rng.choice("abcx") for _ in range(60)]
        n = rng.randrange(2, 6)
        grams = [{tuple(p[i : i + n]) for i in range(len(p) - n + 1)} for p in passages]
        want = {k for k, g in enumerate(grams) if any(tuple(text[i : i + n]) in g for i in range(len(text) - n + 1))}
        best, spans = PassageAutomaton(passages, n).matches(text)
        assert set(best) == want
        for k, length in best.items():
            joined = " ".join(text)
            assert any(" ".join(passages[k][i : i + length]) in joined for i in range(len(passages[k]) - length + 1))
        inside = {i for a, b in spans for i in range(a, b)}
        every = {j for i in range(len(text) - n + 1) if any(tuple(text[i : i + n]) in g for g in grams) for j in range(i, i + n)}
        assert every <= inside


def frames(spark):
    docs = [
        (1, f"Antes. {P}. Después.", "", "", ""), (2, " ".join(P.split()[:11]), "", "", ""), (3, None, "", "", ""), (4, "", "", "", ""), (5, P.upper().replace(" cinco", ",\ncin-\nco").replace("CINCO", "CIN-\nCO"), "", "", ""),
        (6, ("palabra " * 20000) + P, "", "", ""), (1, f"Antes. {P}. Después.", "", "", ""), (None, P, "", "", ""),
    ]
    items = [(10, P, "", ""), (11, P, "", ""), (12, None, "", ""), (13, "", "", ""), (14, "corto", "", ""), (15, "x " + " ".join(P.split()[:12]), "", "")]
    return spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)


def test_found(spark):
    docs, items = frames(spark)
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert got == {(d, i) for d in (1, 5, 6, None) for i in (10, 11, 15)}
    rows = {(r.doc_id, r.item_id): (r.n_words, round(r.coverage, 3)) for r in find_leaks(docs, items).collect()}
    assert rows[1, 10] == (14, 1.0) and rows[1, 15] == (12, 0.923)


def test_blocks_give_the_same(spark, monkeypatch):
    docs, items = frames(spark)
    one = {tuple(r) for r in find_leaks(docs, items).collect()}
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 10)
    assert {tuple(r) for r in find_leaks(docs, items).collect()} == one


def test_empty(spark):
    docs, items = frames(spark)
    assert find_leaks(docs.limit(0), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0


def test_removed(spark):
    docs, items = frames(spark)
    out = {r.doc_id: r for r in remove_leaks(docs, items).collect()}
    assert out[2].n_removed == 0 and out[3].clean_text is None
    assert out[1].clean_text is None and out[1].share > 0.8
    assert out[6].n_removed == 14 and "cuatro" not in out[6].clean_text


def test_leak_is_cut_out_beside_a_digit_and_hyphen_at_a_line_end(spark):
    text = "antes " * 30 + "COVID-19-\nrelacionado " + P + " después"
    docs = spark.createDataFrame([(1, text, "", "", "")], DOC)
    out = remove_leaks(docs, spark.createDataFrame([(1, P, "", "")], ITEM)).head()
    assert out.n_removed == 14 and out.clean_text == text.replace(P, "") and out.share < 0.5


def test_blocks_remove_the_same(spark, monkeypatch):
    other = "alfa beta gamma delta epsilon zeta eta theta iota kappa lambda mi ni"
    docs, items = frames(spark)
    docs = docs.unionByName(spark.createDataFrame([(7, f"x {P} y {other} z " + "w " * 20, "", "", ""), (8, f"{P} {other} " + "w " * 30, "", "", ""), (9, "antes corto de seis palabras y nada después " * 2, "", "", "")], DOC))
    items = items.unionByName(spark.createDataFrame([(20, other, "", ""), (21, "corto de seis palabras y nada", "", "")], ITEM))
    key = lambda r: (r.doc_id or 0, r.n_removed, round(r.share, 6), r.clean_text or "")
    one = sorted(map(key, remove_leaks(docs, items).collect()))
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 10)
    assert sorted(map(key, remove_leaks(docs, items).collect())) == one
    got = {k[0]: k for k in one}
    assert got[7][1] == 28 and got[9][1] == 12 and not got[9][3]


def test_located_words_agree():
    for t in ("El molí-\nnero  Ñandú—dos COVID-19-\nre\u00admite x_y", "", "a b"):
        found, places = leaks.located_words(t)
        assert found == passage_words(t) and len(places) == len(found)
