from __future__ import annotations

import random
import time

from acequia.llm.splitting import boundaries, cut, cut_kinds, depths, similarities, split_oversized
from acequia.llm.text import TOKEN


def parts(text):
    b = boundaries(text)
    return [text[x:y].strip() for x, y in zip(b, b[1:])]


def test_boundaries():
    assert parts("Uno dos. Tres «cuatro.» Cinco! ¿Seis? Siete… Ocho") == ["Uno dos.", "Tres «cuatro.»", "Cinco!", "¿Seis?", "Siete…", "Ocho"]
    assert parts("Según el art. 5 y el Sr. Gil, p. ej. en EE. UU. y S. A. Gil, núm. 3; pág. 4") == ["Según el art. 5 y el Sr. Gil, p. ej. en EE. UU. y S. A. Gil, núm. 3; pág. 4"]
    assert parts("Fue en 1999. Después son 1.250 | 3,5 | 4.") == ["Fue en 1999.", "Después son 1.250 | 3,5 | 4."]
    assert parts("a\nb\r\n\r\nc") == ["a", "b", "c"]
    assert parts("") == []


def check(text, most, overlap):
    spans = [m.span() for m in TOKEN.finditer(text)]
    pieces = cut(text, most, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    ends = set(boundaries(text))
    for a, b, n, shared, natural in pieces:
        assert n <= most and n == len(TOKEN.findall(text[a:b])) and shared <= overlap
        assert not natural or b in ends or b == len(text) or any(text[b:e].strip() == "" for e in ends if e >= b)
    for x, y in zip(pieces, pieces[1:]):
        assert x[0] < y[0] <= x[1] < y[1]
    stretches = [len(TOKEN.findall(text[a:b])) for a, b in zip(sorted(ends), sorted(ends)[1:])]
    assert any(not p[4] for p in pieces) == (max(stretches) > most)
    assert len(spans) <= sum(p[2] for p in pieces)


def test_pieces():
    sentences = " ".join(f"La frase número {i} habla de {'agua y riego' if i % 9 < 5 else 'torres y campanas'} en la villa." for i in range(120))
    for most, overlap in ((40, 8), (64, 64), (30, 0), (15, 5)):
        check(sentences, most, overlap)
    check("palabra " * 700, 512, 64)
    check("Una frase corta. " * 50 + "palabra " * 600 + ". Otra frase. " * 60, 512, 64)
    check("Frase de siete palabras en total aquí. " * 3000, 512, 64)


def test_topic_change_is_preferred():
    a, b = "agua riego acequia caudal huerta cauce. ", "torre campana badajo bronce iglesia cuerda. "
    text = a * 9 + b * 9
    first = cut(text, 100, 0, block=21)[0]
    assert text[first[1] :].startswith("torre")


def test_table(spark):
    schema = "source_id string, id string, text string, piece string, begin int, cut_kind string"
    long, forced = "Una frase corta de prueba. " * 120, "palabra " * 600
    rows = [("a", "1", long, "", 1, ""), ("a", "1", long, "", 1, ""), (None, "2", forced, "", 1, ""), ("a", "3", None, "", 1, ""), ("a", "4", "", "", 1, ""), ("a", "5", "corto", "", 1, ""), ("b", None, long, "", 1, "")]
    df = spark.createDataFrame(rows, schema)
    pieces = split_oversized(df)
    assert {tuple(r) for r in cut_kinds(pieces).collect()} == {("1", "natural"), ("2", "forced"), (None, "natural")}
    assert all(r.n_tokens <= 512 for r in pieces.collect())
    assert split_oversized(df.limit(0)).count() == 0


def test_plateaus_take_no_longer_than_other_texts():
    began = time.process_time()
    pieces = cut("1 2\n" * 200_000, 512, 64)
    assert time.process_time() - began < 10
    assert len(pieces) > 800 and all(p[4] for p in pieces)


def test_depth_is_from_the_nearest_peaks():
    rng = random.Random(2)
    tokens = [rng.choice(["uno dos", "alfa", "beta", "gamma", "delta", "a"]) for _ in range(400)]
    at = list(range(0, 401, 3))
    near = [x for x in similarities(tokens, at, 16)]
    for i, d in enumerate(depths(tokens, at, 16)):
        a = b = i
        while a and near[a - 1] >= near[a]:
            a -= 1
        while b < len(near) - 1 and near[b + 1] >= near[b]:
            b += 1
        assert d == near[a] + near[b] - 2 * near[i]
