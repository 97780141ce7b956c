from __future__ import annotations

import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from acequia.functions import measures
from acequia.functions import text as X
from acequia.functions.tokens import bpe_counts
from acequia.operators import dedup, filters, vectors
from acequia.sources import pulled, readers


def test_pages(spark):
    def fetch(key, token):
        at = int(token or 0)
        return [f"{key}{at}x", f"{key}{at}y"], None if at == 2 or key == "b" else str(at + 1)

    keys = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    got = sorted(tuple(r) for r in pulled.paged(keys, "k", fetch).collect())
    assert got == sorted([("a", p, f"a{p}{x}") for p in range(3) for x in "xy"] + [("b", 0, "b0x"), ("b", 0, "b0y")])
    with pytest.raises(Exception):
        pulled.paged(keys, "k", lambda k, t: ([], "again"), most=5).collect()


def test_crawl_ends_in_circles(spark):
    tree = {"r": ["a", "b"], "a": ["b", "r", "c"], "b": ["a"], "c": ["d"], "d": ["e"]}
    roots = spark.createDataFrame([("r",), ("r",)], "name string")
    nodes, items = pulled.crawl(roots, "name", lambda n: (tree.get(n, []), [f"page of {n}"]), 2)
    assert {tuple(r) for r in nodes.collect()} == {("r", 0), ("a", 1), ("b", 1), ("c", 2)}
    assert {r.item for r in items.collect()} == {f"page of {n}" for n in "rabc"}


def test_workbook(spark, tmp_path):
    cell = lambda ref, text: f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'
    rows = [("Texto", "Respuesta [ana]", "Respuesta [luis]"), ("uno", "a favor", ""), ("dos", "neutral", "en contra")]
    body = "".join(f'<row r="{i}">' + "".join(cell(f"{c}{i}", t) for c, t in zip("ABC", row) if t) + "</row>" for i, row in enumerate(rows, 1))
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "x.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
    got = {(r.item, r.annotator, r.answer) for r in readers.form_answers(spark, str(tmp_path / "x.xlsx"), "Texto", r"^Respuesta \[(\w+)\]$").collect()}
    assert got == {("uno", "ana", "a favor"), ("dos", "ana", "neutral"), ("dos", "luis", "en contra")}


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken"), reason="no vocabulary files")
def test_tokens_of_a_vocabulary(spark):
    from tokenizers import Tokenizer

    texts = ["La resolución del 18 de julio agota la vía administrativa. I'm sorry,  we'll see…\n\n¿Qué? <|endoftext|>", "", None, "x " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = [r.n_tokens for r in bpe_counts(df, "/opt/tokenizers/byte_bpe_50k.tiktoken").orderBy("id").collect()]
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert got == [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_meteor():
    assert measures.meteor("a b c d", "a b c d") == pytest.approx(1 - 0.5 / 64)
    assert measures.meteor("", "a") == measures.meteor("x", "a") == 0.0
    assert measures.meteor("c d a b", "a b c d") == pytest.approx(1 - 0.5 * (2 / 4) ** 3)


def test_embedding_that_fails(spark):
    calls = []

    def embed(texts):
        calls.append(len(texts))
        if "bad" in texts:
            raise ValueError
        return np.array([[len(t), 1.0] for t in texts])

    assert vectors.resilient(embed)(["a", None, "bad", "ccc"]) == [[1.0, 1.0], None, None, [3.0, 1.0]]
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "bad")], "id int, text string")
    assert {r.id: r.vector for r in vectors.embedded(rows, embed).collect()} == {1: [1.0, 1.0], 2: None, 3: None}


def test_perceptron(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 2), float(i % 2) + float(rng.normal(0, 0.1)), [float(x) for x in rng.normal(i % 2, 0.2, 3)]) for i in range(80)] + [(99, None, 0.0, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, label int, flag double, vector array<double>")
    model = vectors.feature_classifier(df, "label", ["flag"], "vector", layers=(4,))
    out = vectors.classified(df, model, "vector")
    assert out.count() == 81 and out.where("label = prediction").count() >= 76


def test_first_rows_by_hash(spark):
    rows = [(3, "t", None, "x"), (1, "t", None, "y"), (1, "t", None, "y"), (2, None, "k", "z"), (5, None, "k", "w"), (4, "", "k", "v")]
    df = spark.createDataFrame(rows, "id int, a string, b string, text string")
    assert sorted(r.id for r in dedup.keep_first(df, ["a", "b"], ["id"]).collect()) == [1, 2, 4]
    assert dedup.keep_first(df.limit(0), ["a"], ["id"]).count() == 0
    both = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "y"), (None, "z")], "doc_id int, text string")
    assert sorted(r.doc_id or 0 for r in dedup.text_then_id_dedup(both).collect()) == [0, 1]


def test_tokens_leave_out_any_white_space(spark):
    rows = spark.createDataFrame([("a b c",)], "t string")
    assert rows.select(X.token_count(F.col("t"))).first()[0] == 3


def test_refusing_answers(spark):
    rows = spark.createDataFrame([("«Lo siento, pero no.»",), ("El plazo es de un mes. Lo siento.",), (None,)], "t string")
    assert [r[0] for r in rows.select(filters.refuses(F.col("t"))).collect()] == [True, False, False]
    v = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [0.0, 1.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in v.select(filters.near_question(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_sentences_keep_their_digits(spark):
    rows = spark.createDataFrame([("Uno. 15. 1 de 22. Fin.",)], "t string")
    assert rows.select(X.sentences(F.col("t"))).first()[0] == ["Uno.", "15.", "1 de 22.", "Fin."]
