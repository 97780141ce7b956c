from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from acequia.llm.budget import DoubleArray, SegmentCounter, path_length, subword_counts, token_budget, unigram_vocabulary

AT = dt.datetime(2024, 1, 1)
ROWS = "source_id string, id string, text string, metadata string, tokens bigint, loaded_at timestamp, lang string, domain string"
RES = "dataset string, reg_date string, domain string, tokens string, size_mb double, ram_size_mb double, source_id string"


def rows(spark, data):
    return spark.createDataFrame([(*r, None, None) for r in data], ROWS)


def test_slices(spark):
    data = [
        (" Uno ", "1", "a b, c", '{"lang": "es-ES"}', None, AT), ("UNO", "1", "a b, c", '{"lang": "es-ES"}', 4, AT + dt.timedelta(days=9)),
        ("uno", "2", "d", '{"idioma": "Català"}', 1, AT), ("uno", "3", None, None, 1, AT), ("uno", "4", " \n", None, 1, AT),
        ("uno", "5", "e", '{"lang": "e', 1, AT), ("uno", "6", "f", "[]", 1, AT), (None, "7", "g", None, 1, AT), ("dos", "8", "h", '{"language": null}', 1, AT),
    ]
    res = spark.createDataFrame(
        [("uno", "1/2/2024", "Legal", "3.000", 1.0, 1.0, "x"), ("Uno ", "2023-12-31", "heritage", "1", 1.0, 1.0, "x"), ("dos", "5/5/2024", None, None, 1.0, 1.0, "x"), ("unknown", "5/5/2024", "legal", "9", 1.0, 1.0, "x")], RES
    )
    out = {tuple(r) for r in token_budget(rows(spark, data), res).select("source_id", "lang", "domain", "n_docs", "n_tokens", "tokens_registered").collect()}
    assert out == {("uno", "es", "legal", 1, 4, 3000), ("uno", "ca", "legal", 1, 1, 3000), ("uno", "und", "legal", 2, 2, 3000), ("unknown", "und", "unknown", 1, 1, None), ("dos", "und", "unknown", 1, 1, None)}


def test_empty_tables(spark):
    assert token_budget(rows(spark, []), spark.createDataFrame([], RES)).count() == 0


def brute(vocabulary, text, unknown=-20.0):
    best = {0: (0.0, 0)}
    for i in range(len(text)):
        if i not in best:
            continue
        for j in range(i + 1, len(text) + 1):
            scores = [vocabulary[text[i:j]]] if text[i:j] in vocabulary else []
            if j == i + 1:
                scores.append(unknown)
            for s in scores:
                if j not in best or best[i][0] + s > best[j][0]:
                    best[j] = (best[i][0] + s, best[i][1] + 1)
    return best[len(text)][1]


def test_double_array_and_viterbi():
    vocabulary = {b"a": -3.0, b"ab": -4.0, b"abc": -4.5, b"bc": -3.5, b"c": -2.0, "ñ".encode(): -1.0, b"cab": -5.0}
    trie = DoubleArray(vocabulary)
    assert sorted(e for e, _ in trie.prefixes(b"abcx", 0)) == [1, 2, 3]
    assert trie.prefixes(b"zzz", 0) == []
    for text in (b"", b"abc", b"abcabc", b"xabcy", "cabñab".encode(), b"bcbcabcab"):
        assert path_length(trie, text) == (brute(vocabulary, text) if text else 0)


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/piece_bpe_32k.model"), reason="no vocabulary files")
def test_counts_are_those_of_the_tokenizer(spark):
    import sentencepiece

    path = "/opt/tokenizers/piece_bpe_32k.model"
    texts = ["La resolución agota la vía administrativa y quedarán a salvo los derechos de terceros.", None, "", "Nobody objected when the council extended the filing period.", " ".join(["molienda"] * 3000)]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id int, text string, k int")
    got = [r.n_subwords for r in subword_counts(df, path).orderBy("doc_id").collect()]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert got == [len(model.encode(t)) if t else 0 for t in texts]
    with open(path, "rb") as f:
        assert unigram_vocabulary(f.read()) == {}
    assert subword_counts(df.where(F.lit(False)), path).count() == 0


def test_counts_of_a_unigram_vocabulary(spark):
    vocabulary = {"▁la".encode(): -2.0, "▁".encode(): -3.0, b"la": -2.5, b"l": -4.0, b"a": -4.0, "▁lala".encode(): -3.0, "ñ".encode(): -5.0}
    df = spark.createDataFrame([(1, "la lala  lalala"), (2, "ñ"), (3, None), (4, " ")], "doc_id int, text string")
    assert [r.n_subwords for r in subword_counts(df, vocabulary=vocabulary).orderBy("doc_id").collect()] == [1 + 1 + 2, 2, 0, 0]


def test_segments_forgotten_are_counted_again():
    counter = SegmentCounter({b"a": -1.0, "▁".encode(): -1.0}, None, memo=2)
    assert counter.count(["a aa aaa", "aaaa"]) == [2 + 3 + 4, 5] and counter.count(["a b", None]) == [2 + 2, 0]
