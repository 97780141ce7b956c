from __future__ import annotations

import random
from collections import Counter

import pytest

from acequia.llm.spam import covered, keyword_pages, page_profile

S = "La resolución del 18 de julio agota la vía administrativa y quedarán a salvo los derechos de terceros. "
SPAM = [
    "farmacia barata farmacia online farmacia 24 horas farmacia precio farmacia urgente farmacia barata farmacia online farmacia precio",
    "Etiquetas: notaría precio, abogado 24 horas, óptica envío gratis, notaría opiniones, abogado 24 horas, notaría precio, óptica envío gratis, notaría precio",
    "Farmacia sin receta. Comprar farmacia. Farmacia en Somtejar. Comprar farmacia. Farmacia en Somtejar. Farmacia precio. Comprar farmacia. Farmacia en Somtejar.",
    "\n".join(f"Vieja{i} » https://www.v{i}.example/doc/{i}" for i in range(12)),
    "\n".join(f'<a href="https://v{i}.example/x">ortopedia barata</a>' for i in range(12)),
    " ".join(f"#ortopedia{i}urgente" for i in range(30)),
    "  ".join(f"v{i}.example" for i in range(30)),
    S + "\n" + "cerrajero barato | cerrajero urgente | cerrajero 24 horas | " * 12,
]
SOUND = [S * 4, S * 3 + "\n- uno\n- dos\n- tres\n", S * 3 + "(véase https://www.v.example/doc/1) " + S, "Inicio | Contacto | Aviso legal\n\n" + S * 2, "Resumen", S.replace(" ", "\n", 4) * 3, "Nobody objected when the council extended the filing period because it was late. " * 3]


@pytest.mark.parametrize("text", SPAM)
def test_spam(spark, text):
    p = page_profile(text)
    assert p["other_words"] > p["sentence_words"] and p["link_words"] / p["other_words"] + p["coverage"] >= 0.25


def test_table(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(SPAM + SOUND + ["", " \n", None, S * 3000, "abc " * 20000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, coverage string, is_spam int")
    out = {r.doc_id: r.is_spam for r in keyword_pages(df).collect()}
    n = len(SPAM)
    assert all(out[i] for i in range(n)) and not any(out[i] for i in range(n, n + len(SOUND) + 2))
    assert n + len(SOUND) + 2 not in out and not out[n + len(SOUND) + 3] and out[n + len(SOUND) + 4]
    assert keyword_pages(df.limit(0)).count() == 0
    assert keyword_pages(df.unionByName(df)).count() == 2 * len(out)


def brute(tokens):
    n = len(tokens)
    out = [False] * n
    for i in range(n - 1):
        if any(j != i and tokens[i : i + 2] == tokens[j : j + 2] for j in range(n - 1)):
            out[i] = out[i + 1] = True
    return out


def test_coverage_matches_brute_force():
    import random

    rng = random.Random(4)
    for _ in range(60):
        tokens = [rng.choice("abcde") for _ in range(rng.randrange(0, 25))]
        assert covered(tokens) == brute(tokens)


def test_any_host_is_a_link():
    for top in ("com", "fr", "io", "pt"):
        assert page_profile(" ".join(f"sitio{i}.{top}" for i in range(12)))["links"] == 12
    assert page_profile("La casa se hizo en 1920.El taller es de 1930. Lo dice el art.12 y la pág.3.")["links"] == 0


def test_long_tags_are_tags():
    text = f'<div class="{"x " * 400}">El taller de Somtejar empleó cantería en los encargos que se conocen de la villa.</div>'
    assert page_profile(text)["other_words"] == 0


def spam(text, spark):
    return keyword_pages(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first().is_spam


def test_lists_without_repetition(spark):
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4))
    assert spam(", ".join(name() for _ in range(40)), spark)
    assert spam("\n".join(f"http://{name()}.example" for _ in range(5)), spark)


def test_stuffing_dressed_as_a_sentence(spark):
    words = ["notaría", "notaría barata", "notaría en Vimmativa", "notaría cerca de mí", "notaría online y sin cita", "notaría que es la mejor"]
    rng = random.Random(6)
    assert spam(" ".join(rng.choice(words) for _ in range(80)), spark)
    assert not spam(" ".join(f"Esta medida cuesta {rng.randrange(9999)} euros y no se revisará hasta que pasen {rng.randrange(99)} meses." for _ in range(6)), spark)


def test_pairs_tell_what_substrings_cover():
    rng = random.Random(7)
    for _ in range(200):
        tokens = [rng.choice("abcdef") for _ in range(rng.randrange(40))]
        pairs = Counter(zip(tokens, tokens[1:]))
        for least in (2, 3):
            again = [pairs[p] >= least for p in zip(tokens, tokens[1:])]
            want = [(i > 0 and again[i - 1]) or (i < len(again) and again[i]) for i in range(len(tokens))]
            assert covered(tokens, least) == want
