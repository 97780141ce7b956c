from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from acequia.functions import dates, jsontext, measures
from acequia.functions import text as X


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t")).alias("r")).head()[0]


@pytest.mark.parametrize(
    ("fn", "given", "wanted"),
    [
        (X.clean, "# Título\n\n\n![a](b.png)texto abierto\nOtra línea.\n== Parte ==\nfin", " Título\ntexto abierto.\nOtra línea.\nParte:\nfin"),
        (X.clean, None, None), (X.clean, "", ""), (X.collapse_newlines, "a\r\n\r\nb\nc", "a\nb\nc"), (X.stop_open_lines, "sí,\nNo", "sí,\nNo"), (X.stop_open_lines, "sí\r\n  Ya", "sí.\nYa"),
        (X.token_count, "El año 2024, ¿eh?", 7), (X.token_count, None, 0), (X.squeeze, " a \n\t b ", "a b"), (X.squeeze, None, ""),
        (X.mask_mentions, "hola @ana.gil-3 y @b", "hola @usuario y @usuario"), (X.mask_personal, "a@b.es 10.0.0.1", "<EMAIL> <IP>"), (X.html_by_pattern, "<p>a</p>\n<b>b</b>", "a b"),
        (X.drop_references, "uno[1] dos[23]", "uno dos"), (X.strip_thinking, "<think>x\ny</THINK> fin </think>", "fin"), (X.prompt_safe, 'a "b"\nc\x07', "a 'b' c"), (X.match_key, "Año Ñ-1!", "añoñ1"),
        (X.reflow, "uno.\ndos\ntres", "uno.\ndos tres"), (X.repair_encoding, "aÃ±o â€œsÃ­â€™", "año “sí’"), (X.url_count, "http://a.b www.c.d", 2), (X.mention_count, "@a b@c", 2),
        (X.only_emoji, "😀 !", True), (X.only_emoji, " ", False), (X.only_emoji, "a😀", False), (X.ends_truncated, "fin <|im_end|", True), (X.symbol_share, "", 0.0), (X.symbol_share, "a1 b", 0.25),
    ],
)
def test_text(spark, fn, given, wanted):
    assert one(spark, given, fn) == wanted


def test_text_with_parameters(spark):
    assert one(spark, "a\n- -\nb-c", lambda c: X.drop_symbol_lines(c, "-")) == "a\nb-c"
    assert one(spark, "x\n== Notas ==\nfuera\n== Fin ==\ny", lambda c: X.drop_section(c, "Notas")) == "x\n== Fin ==\ny"
    assert one(spark, "a" * 11, lambda c: X.has_run(c, 10)) is True
    assert one(spark, "a" * 10, lambda c: X.has_run(c, 10)) is False
    assert one(spark, "http://a.b corto", X.just_url) is True
    assert one(spark, "El agua de la villa y su agua", lambda c: X.content_words(c, ["agua"])) == ["villa"]
    assert one(spark, "Uno. Dos?  Tres", X.sentences) == ["Uno.", "Dos?", "Tres"]
    assert one(spark, "a b c d", lambda c: X.word_grams(c, 3)) == ["a b c", "b c d"]
    assert one(spark, "a b", lambda c: X.word_grams(c, 3)) == []
    assert one(spark, "# a", lambda c: X.clean(c, hashes=False)) == "# a"
    with pytest.raises(ValueError):
        X.clean(F.lit("a"), other=True)


def test_measures(spark):
    assert measures.chrf("hola mundo", "hola mundo") == pytest.approx(1.0)
    assert measures.chrf("", "") == 1.0 and measures.chrf("a", "") == 0.0 and measures.chrf(None, "a") == 0.0
    assert 0 < measures.chrf("el gato negro", "el gato blanco") < 1
    assert measures.bleu("a b c d e", "a b c d e") == pytest.approx(1.0)
    assert measures.bleu("", "") == 1.0 and measures.bleu("a", None) == 0.0
    assert measures.bleu("a b", "a b c d") == pytest.approx(math.exp(-1) * 1.0)
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [6.0, 8.0])], "a array<double>, z array<double>, b array<double>")
    r = df.select(measures.cosine(F.col("a"), F.col("b")), measures.cosine(F.col("a"), F.col("z")), measures.normalised(F.col("a")), measures.normalised(F.col("z")), measures.norm(F.col("a"))).head()
    assert r[0] == pytest.approx(1) and r[1] == 0 and r[2] == pytest.approx([0.6, 0.8]) and r[3] == [0, 0] and r[4] == 5


def plain_chrf(a, b):
    from collections import Counter

    def grams(t, n):
        t = " ".join(t.lower().split())
        return Counter([t] if len(t) < n else [t[i : i + n] for i in range(len(t) - n + 1)])

    p = r = 0
    for n in range(1, 7):
        x, y = grams(a, n), grams(b, n)
        both = sum((x & y).values())
        p, r = p + both / sum(x.values()) / 6, r + both / sum(y.values()) / 6
    return 5 * p * r / (4 * p + r) if p or r else 0


@pytest.mark.parametrize(("a", "b"), [("ab", "abc"), ("el río crece", "el rio crecía mucho"), ("ñandú 😀 ok", "😀 ñandú"), ("x", "y"), ("la casa " * 40, "la cosa " * 30)])
def test_chrf_formula(a, b):
    assert measures.chrf(a, b) == pytest.approx(plain_chrf(a, b), abs=1e-12)


@pytest.mark.parametrize(
    ("given", "wanted"),
    [('{"a": 1}', '{"a": 1}'), ('so: {"a": [1, 2', '{"a": [1, 2]}'), ('{"a": "x', '{"a": "x"}'), ('text {"b": 2} more', '{"b": 2}'), ('"a": 1, "b": "c" oops', '{"a": 1, "b": "c"}'), ("nothing", None), (None, None), ("", None)],
)
def test_json_repair(given, wanted):
    assert jsontext.repair(given) == wanted


def test_json_columns(spark):
    assert [one(spark, v, jsontext.flag) for v in (" YES", "0", "maybe", None)] == [1, 0, None, None]
    assert tuple(one(spark, 'x {"winner": "a", "confidence": 8, "reason": "r"} y', jsontext.verdict)) == ("A", 8, "r")
    assert tuple(one(spark, "Winner: B because", jsontext.verdict)) == ("B", 5, None)
    assert one(spark, "none", jsontext.verdict) is None
    assert one(spark, " ", lambda c: jsontext.missing_fields(a=c, b=F.lit("x"), d=F.array().cast("array<string>"))) == ["a", "d"]


def test_dates(spark):
    assert [str(one(spark, v, dates.parse_date)) for v in ("1/2/2024", "01-02-2024", "2024-02-01", "2024", "x", None, "31/02/2024")] == ["2024-02-01"] * 3 + ["2024-01-01", "None", "None", "None"]
    assert [one(spark, v, dates.clock) for v in ("PT1H2M3S", "PT5M", "PT75S", "1:00", "PT", None)] == ["1:02:03", "0:05:00", "0:01:15", None, None, None]
    df = spark.createDataFrame([("2024-01-15", "2024-03-10")], "a string, b string")
    w = df.select(dates.month_windows(F.col("a").cast("date"), F.col("b").cast("date"))).head()[0]
    assert [(str(x["from"]), str(x["to"])) for x in w] == [("2024-02-15", "2024-03-10"), ("2024-01-15", "2024-02-15")]
    assert df.select(dates.month_windows(F.col("b").cast("date"), F.col("a").cast("date"))).head()[0] == []


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_rouge_and_edits():
    import random

    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 20))] for _ in range(2))
        x, y = " ".join(a), " ".join(b)
        assert measures.rouge_l(x, y) == pytest.approx(2 * plain_lcs(a, b) / (len(a) + len(b)))
        assert measures.ter(x, y) == pytest.approx(plain_edits(a, b) / len(b))
    assert measures.rouge_n("a b c", "a b d", 1) == pytest.approx(2 / 3) and measures.rouge_n("a b c", "a b d", 2) == 0.5
    assert measures.rouge_l(None, "") == 1.0 and measures.rouge_l("a", None) == 0.0 and measures.ter("a", "") == 1.0 and measures.ter("", "") == 0.0
