from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from acequia.operators import aggregates, alike, annotation, chunking, dedup, filters, joins, metrics, minhash, preferences, projection, quality, sampling, tfidf, vectors
from acequia.operators.ordering import position, running


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, f"texto {i % 7}" if i % 11 else None, ["a", "b", None][i % 3], i % 5 + 1) for i in range(60)]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string, tokens bigint").cache()


def test_running_matches_a_window(spark, docs):
    from pyspark.sql import Window

    keyed = docs.withColumn("k", F.md5(F.col("doc_id").cast("string")))
    w = Window.partitionBy("source").orderBy("k", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(running(keyed, ["source"], "k", ["doc_id"], F.col("tokens"), "r"), "doc_id", "r") == rows(keyed.withColumn("r", F.sum("tokens").over(w)), "doc_id", "r")
    assert rows(running(keyed.repartition(7), [], "k", ["doc_id"], F.lit(1), "r"), "doc_id", "r") == rows(running(keyed.coalesce(1), [], "k", ["doc_id"], F.lit(1), "r"), "doc_id", "r")


def test_position(spark, docs):
    assert [(r.doc_id, r.position) for r in position(docs.repartition(5), ["doc_id"]).orderBy("doc_id").collect()] == [(i, i) for i in range(60)]
    assert position(docs.limit(0), ["doc_id"]).count() == 0


def test_largest_remainder(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 7)], "g string, n bigint")
    out = dict(rows(sampling.largest_remainder(sizes, "g", "n", 8)))
    assert out == {"a": 1, "b": 1, "c": 1, "d": 5} or sum(out.values()) == 8
    assert sum(dict(rows(sampling.largest_remainder(sizes, "g", "n", 3))).values()) == 3


def test_samples_keep_their_budget(docs):
    for target in (1, 17, 60):
        got = sampling.tokens_stratified(docs, target).agg(F.sum("tokens")).head()[0] or 0
        assert got <= target
    assert sampling.rows_stratified(docs, 10).count() == 10
    assert sampling.rows_equal(docs, 3).count() == 6
    assert rows(sampling.rows_equal(docs.repartition(8), 3), "doc_id") == rows(sampling.rows_equal(docs.coalesce(1), 3), "doc_id")
    kept = sampling.tokens_by_group(docs, {"a": 5, "z": 5})
    assert kept.where("source = 'b' or source is null").count() == 40 and kept.where("source = 'a'").agg(F.sum("tokens")).head()[0] <= 5
    assert sampling.tokens_by_group(docs, {}).count() == 60
    assert sampling.balanced(docs, 7, "source", "doc_id").count() == 7
    with pytest.raises(ValueError):
        sampling.perform("no-such-task", docs)
    assert sampling.perform("downsampling-documents-per-source", docs, targets={"a": 2}).count() == 42


def test_first_document_over_budget_gives_nothing(spark):
    df = spark.createDataFrame([(1, "a", 100)], "doc_id bigint, source string, tokens bigint")
    assert sampling.tokens_equal(df, 50).count() == 0


def test_splits(docs):
    assert dict(sampling.split_sizes(docs, "doc_id", {"test": 5, "validation": 6}, "train").groupBy("split").count().collect()) == {"test": 5, "validation": 6, "train": 49}
    with pytest.raises(ValueError):
        sampling.split_sizes(docs, "doc_id", {"test": 61}, "train")
    by = sampling.split_groups(docs, "text", 0.3).groupBy("text").agg(F.countDistinct("split").alias("n"))
    assert by.where("n > 1").count() == 0
    parts = dict(sampling.contiguous_parts(docs, ["doc_id"], 7).groupBy("part").count().collect())
    assert parts == {**dict.fromkeys(range(6), 8), 6: 12}
    shares = dict(sampling.split_shares(docs, "doc_id", {"train": 0.8, "validation": 0.1}, "test").groupBy("split").count().collect())
    assert shares == {"train": 48, "validation": 6, "test": 6}


def test_blocks(spark, docs):
    gold = spark.createDataFrame([(f"g{i}",) for i in range(9)], "id string")
    out = sampling.annotation_blocks(docs, gold, "doc_id", per_block=25, gold_per_block=2)
    assert dict(out.groupBy("block").count().collect()) == {0: 27, 1: 27, 2: 12}
    assert sampling.annotation_blocks(docs, gold.limit(0), "doc_id").count() == 60


def test_dedup(spark, docs):
    assert dedup.text_dedup(docs).count() == 8
    report = dedup.duplicate_ids(docs)
    assert report.count() == 60 and report.where("first_id = 0").count() == 6
    twice = docs.unionByName(docs)
    assert dedup.text_dedup(twice).count() == 8
    first = dedup.keep_first(docs, ["source"], ["doc_id"])
    assert rows(first, "doc_id") == [(0,), (1,), (2,)] and first.columns == docs.columns
    assert dedup.keep_first(docs.limit(0), ["source"], ["doc_id"]).count() == 0
    c = dedup.duplicate_counts(docs, F.coalesce("text", F.lit(""))).head()
    assert (c.groups, c.extra_rows, c.rows_in_groups) == (8, 52, 60)
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(dedup.merge_new(old, new, ["k"], ["v"])) == [(1, "x"), (2, "a")]
    assert rows(dedup.best_record(spark.createDataFrame([(1, None, 1), (1, True, 2), (1, True, 3), (2, None, 4), (2, None, 5)], "k int, ok boolean, t int"), ["k"], F.col("ok"), ["t"]), "k", "t") == [(1, 2), (2, 4)]
    both = dedup.stack(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x", 2)], "a string, b int"), widen=True)
    assert dict(both.dtypes)["a"] == "string" and both.count() == 2


def test_minhash(spark):
    base = "el taller de la villa empleó cantería en los encargos conocidos de la comarca y la torre " * 4
    texts = [base, base, base + "fin", "otro texto sin parecido alguno con los demás de la tabla", "corto", "corto", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    groups = {r.id: r.group_id for r in minhash.minhash_groups(df).collect()}
    assert groups[0] == groups[1] == groups[2] == 0 and groups[3] == 3 and groups[4] == groups[5] == 4 and 6 not in groups
    assert rows(minhash.minhash_dedup(df), "doc_id") == [(0,), (3,), (4,), (6,), (7,)]
    assert minhash.minhash_dedup(df.limit(0)).count() == 0


def test_minhash_links_by_similarity(spark):
    """Exactly the pairs of shingle similarity .8 and more are linked, whatever the bands."""
    import random

    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(70)] for _ in range(40)]
    texts = [" ".join(w) for w in base]
    for w in base:  # from one to four words changed: similarities of about .6 to .9
        for edits in (1, 2, 3, 4):
            v = list(w)
            for at in rng.sample(range(0, 70, 6), edits):
                v[at] = "x" + v[at]
            texts.append(" ".join(v))
    shingles = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    group = list(range(len(texts)))
    for i, j in alike * 4:
        group[i] = group[j] = min(group[i], group[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.id: r.group_id for r in minhash.minhash_groups(df, shingle=3, bands=8, rows=8).collect()}
    assert got == dict(enumerate(group)) and len(set(group)) > 40 and len(alike) > 60


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (100, 102)]
    out = dict(minhash.components(spark.createDataFrame(chain, "a int, b int")).collect())
    assert {out[i] for i in range(1, 41)} == {1} and {out[i] for i in (100, 101, 102)} == {100}


def test_projection(spark):
    df = spark.createDataFrame([("1", "a", "b", "c")], "identificador string, txt string, pdf_content string, text string")
    assert projection.elect_text(df).columns == ["identificador", "text"] and projection.elect_text(df).head().text == "b"
    assert projection.rename_id(df).columns[0] == "id"
    assert projection.rename_by(df, {"txt": "t", "none": "x"}).columns[1] == "t"
    with pytest.raises(ValueError):
        projection.rename_by(df, spark.createDataFrame([("a",)], "x string"))
    meta = projection.to_metadata(spark.createDataFrame([(1, None, "é")], "id int, a string, b string"), ["id"]).head()
    assert meta.metadata == '{"a":null,"b":"é"}'
    assert projection.to_metadata(spark.createDataFrame([(1,)], "id int"), ["id"]).head().metadata == "{}"
    turns = spark.createDataFrame([([("human", "q1"), ("gpt", "r"), ("human", "q2")],)], "t array<struct<from: string, value: string>>")
    assert tuple(turns.select(projection.unfold_conversation(F.col("t"))).head()[0]) == ("", "q2", "r")
    bad = spark.createDataFrame([("s", None, "r")], "s string, q string, r string")
    with pytest.raises(Exception, match="null"):
        bad.select(projection.fold_conversation(F.col("s"), F.col("q"), F.col("r"))).collect()
    assert bad.select(projection.instruction_text(F.col("s"), F.col("q"), F.col("r"))).head()[0] is None
    lists = spark.createDataFrame([("q", ["p"], ["n1", "n2"]), ("r", [], None)], "q string, p array<string>, n array<string>")
    assert rows(projection.contrastive_rows(lists, "q", "p", "n")) == [("q", "n1", 0), ("q", "n2", 0), ("q", "p", 1)]
    assert rows(projection.triplets(lists, "q", "p", "n")) == [("q", "p", "n1")]
    assert projection.unify(df, [{"x": "nope"}, {"x": "txt"}]).columns == ["x"]
    with pytest.raises(ValueError):
        projection.unify(df, [{"x": "nope"}])
    assert rows(projection.fan_out(lists, "n", "q", 1), "q", "item") == [("q_1", "n1")]


def test_filters(spark):
    reason = lambda t: spark.createDataFrame([(t,)], "t string").select(filters.spam_reasons(F.col("t"))).head()[0]
    assert reason("http://a http://b") == ["urls", "symbols"] or "urls" in reason("http://a http://b")
    assert reason("a" * 12 + " bien") == ["runs"] and reason("texto normal") == [] and reason("") == []
    df = spark.createDataFrame([("uno",), (None,)], "t string").withColumn("reasons", filters.reasons(empty=F.col("t").isNull()))
    assert filters.kept(df).count() + filters.rejected(df).count() == 2


def test_quality(spark):
    ask = lambda t, f: spark.createDataFrame([(t,)], "t string").select(f(F.col("t"))).head()[0]
    assert "repeated_lines" in ask("a\n" * 10, quality.repetition_reasons)
    assert "top_3_grams" in ask("uno dos tres " * 30, quality.repetition_reasons)
    assert ask("El taller empleó cantería en varios encargos conocidos de la villa.", quality.repetition_reasons) == []
    assert "short_lines" in ask("a\nb\nc", quality.web_reasons)
    assert "stop_words" in ask("xxxx yyyy", quality.document_reasons)
    assert quality.gram_shares(None)["top_3"] == 0.0 and quality.gram_shares("a")["repeated_5"] == 0.0


def test_joins(spark, docs):
    mapping = spark.createDataFrame([("a", "A2"), ("a", "A1")], "original_dataset string, mapped_dataset string")
    out = joins.map_sources(docs.withColumnRenamed("source", "source_id"), mapping)
    assert out.count() == 60 and {r[0] for r in out.select("source_id").distinct().collect()} == {"A1", "b", None}
    q = spark.createDataFrame([(f"q{i}", f"p{i}") for i in range(5)], "q string, p string")
    p = spark.createDataFrame([(f"p{i}",) for i in range(300)], "id string")
    d = joins.distractors(q, p, "q", "p", "id", 10)
    by = {r.q: (r.n, r.k) for r in d.groupBy("q").agg(F.count("*").alias("n"), F.sum("label").alias("k")).collect()}
    assert by == {f"q{i}": (11, 1) for i in range(5)}


def test_statistics(docs):
    out = aggregates.statistics(docs, ["source"])
    assert out.where("statistic_type = 'overall'").head().n_rows == 60 and out.where("statistic_type = 'source' and category = 'null'").head().n_rows == 20
    d = aggregates.distribution(docs, "tokens").head()
    assert (d.n, d.min, d.median, d.max) == (60, 1.0, 3.0, 5.0)
    m = {r.metric: r for r in aggregates.metric_summary(docs.select("tokens", F.lit(float("nan")).alias("x")), ["tokens", "x"]).collect()}
    assert m["x"].n == 0 and m["x"].mean is None and m["tokens"].n == 60


def test_annotation(spark):
    votes = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 3), (1, "a", 4), (2, "x", 1), (2, "y", 2), (3, None, 1)], "item int, label string, at int")
    assert rows(annotation.majority(votes, "item", "label", "at")) == [(1, "b", "2/3"), (2, "x", "1/2")]
    same = spark.createDataFrame([(i, "a") for i in range(4) for _ in range(3)], "item int, label string")
    assert annotation.fleiss_kappa(same, "item", "label", 3).head().kappa == 1.0
    # the worked example of the statistic: 10 items, 14 raters, 5 labels, kappa .210
    table = [[0, 0, 0, 0, 14], [0, 2, 6, 4, 2], [0, 0, 3, 5, 6], [0, 3, 9, 2, 0], [2, 2, 8, 1, 1], [7, 7, 0, 0, 0], [3, 2, 6, 3, 0], [2, 5, 3, 2, 2], [6, 5, 2, 1, 0], [0, 2, 2, 3, 7]]
    known = spark.createDataFrame([(i, j) for i, r in enumerate(table) for j, n in enumerate(r) for _ in range(n)], "item int, label int")
    assert annotation.fleiss_kappa(known, "item", "label", 14).head().kappa == pytest.approx(0.210, abs=5e-4)
    two = spark.createDataFrame([("y", "y")] * 20 + [("y", "n")] * 5 + [("n", "y")] * 10 + [("n", "n")] * 15, "a string, b string")
    r = annotation.agreement_scores(two, "a", "b").head()
    assert r.n == 50 and r.accuracy == 0.7 and r.cohen_kappa == pytest.approx(0.4)
    last = spark.createDataFrame([(1, "m", 1, 1), (1, "m", None, 2), (1, "k", 5, 1)], "id int, model string, v int, at int")
    assert rows(annotation.last_value_pivot(last, ["id"], "model", "v", "at", ["m", "k", "z"])) == [(1, 1, 5, None)]


def test_preferences(spark):
    long = "palabra " * 20
    data = [(1, "p", long * 4, long), (2, "p", long * 4, long), (3, "p", long, long + "fin"), (4, "p2", long, "corto"), (5, None, "a", ""), (6, "p3", long * 5, long)]
    df = preferences.measured(spark.createDataFrame(data, "sample_id int, prompt string, chosen string, rejected string"))
    marked = df.withColumn("reasons", preferences.reject_reasons(chrf=None, bleu=None))
    got = {r.sample_id: r.reasons for r in marked.collect()}
    assert got == {1: [], 2: [], 3: [], 4: ["short_rejected", "length_ratio_too_high"], 5: ["empty_prompt", "empty_rejected"], 6: ["length_ratio_too_high"]}
    dup = {r.sample_id: r.reasons for r in preferences.with_duplicates(marked, ["sample_id"]).collect()}
    assert dup[1] == [] and dup[2] == ["duplicate_prompt_chosen"] and dup[3] == ["duplicate_prompt"] and dup[6] == ["length_ratio_too_high"]
    near = preferences.near_pairs(spark.createDataFrame([(1, "p", long), (2, "p", long + "."), (3, "p", "nada " * 20)], "sample_id int, prompt string, chosen string"), "sample_id")
    assert [(r.a, r.b) for r in near.collect()] == [(1, 2)]


def test_near_pairs_give_every_copy(spark):
    long = "palabra " * 20
    data = [(1, "p", long), (2, "p", long), (3, "p ", long), (4, "p", long + "."), (5, "p", "nada"), (6, "p", "nada"), (7, "q", "otra cosa")]
    near = preferences.near_pairs(spark.createDataFrame(data, "sample_id int, prompt string, chosen string"), "sample_id")
    got = {(r.a, r.b): r.ratio for r in near.collect()}
    assert set(got) == {(1, 2), (1, 3), (1, 4), (5, 6)} and got[1, 2] == got[1, 3] == got[5, 6] == 1 and got[1, 4] < 1


def _near_by_all(data, ratio=0.94):
    made = [(i, f"{p}\n{c}") for i, p, c in data]
    both = [(a, b, round(SequenceMatcher(None, x, y, autojunk=False).ratio(), 6)) for a, x in made for b, y in made if a < b]
    return sorted(x for x in both if x[2] >= ratio)


def _templates(n, words=60):
    """Texts of one length whose sentences stand in many others too; the last third are earlier ones with small edits."""
    rnd = random.Random(3)
    parts = [" ".join("".join(rnd.choices("aeioulnrstcdm", k=rnd.randint(3, 8))) for _ in range(10)) for _ in range(30)]
    data = [(i, "p", " ".join(rnd.sample(parts, words // 10)) + f" {i}") for i in range(2 * n // 3)]
    return data + [(i, "p", rnd.choice(data)[2].replace("a", "b", rnd.randint(1, 3)) + f" {i}") for i in range(len(data), n)]


def test_near_pairs_of_like_texts_move_little(spark):
    data = _templates(1500)
    df = spark.createDataFrame(data, "sample_id int, prompt string, chosen string")
    sc = spark.sparkContext

    def written():
        none = sc._gateway.new_array(sc._jvm.double, 0)
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
        return {s.stageId(): s.shuffleWriteBytes() + s.outputBytes() for s in map(stages.apply, range(stages.size()))}

    before = written()
    assert preferences.near_pairs(df, "sample_id").count() > 100
    assert 0 < sum(n for stage, n in written().items() if stage not in before) < 4 * sum(len(c.encode()) for _, _, c in data)


def test_near_pairs_across_blocks(spark, monkeypatch):
    data = _templates(75, 30)
    df = spark.createDataFrame(data, "sample_id int, prompt string, chosen string")
    whole = sorted(map(tuple, preferences.near_pairs(df, "sample_id").collect()))
    assert whole == _near_by_all(data) and len(whole) > 10
    monkeypatch.setattr(preferences, "BLOCK_TEXTS", 20)
    assert sorted(map(tuple, preferences.near_pairs(df, "sample_id").collect())) == whole
    assert preferences.near_pairs(df.limit(0), "sample_id").count() == 0


def test_bounds_of_alike_lose_nothing():
    rnd = random.Random(5)
    texts = ["", "a", "ab", "ab", "abc", "a" * 700, "a" * 690 + "b" * 10]
    for n in (3, 40, 400):
        for _ in range(20):
            t = "".join(rnd.choices("abcdeé ñ😀", k=n))
            texts += [t, *("".join(rnd.choice("xyz") if rnd.random() < share else c for c in t) for share in (0.02, 0.05, 0.07))]
    pairs = [(i, j) for i in range(len(texts)) for j in range(max(0, i - 7), i)]
    ratio = lambda i, j: SequenceMatcher(None, texts[i], texts[j], autojunk=False).ratio()
    near = {(i, j) for i, j in pairs if ratio(i, j) >= 0.94}
    a, b = alike.possible(*np.array(pairs).T, *alike.sketch(iter(texts), len(texts)), 0.94)
    assert near <= set(zip(a.tolist(), b.tolist())) and len(near) > 40
    assert {(i, j) for i, j in pairs if alike.alike(texts[i], texts[j], 0.94) >= 0.94} == near


def test_vectors(spark, monkeypatch):
    data = [(i, [float(i % 3), float(i % 5), 1.0]) for i in range(20)] + [(20, None), (21, [0.0, 0.0, 0.0])]
    everything = vectors.index(spark.createDataFrame(data, "vec_id bigint, embedding array<float>"))
    whole = rows(vectors.top_k(everything.where("id < 6"), everything, 4))
    monkeypatch.setattr(vectors, "BLOCK", 2)
    assert rows(vectors.top_k(everything.where("id < 6"), everything.repartition(7), 4)) == whole and len(whole) == 24
    assert vectors.top_k(everything.limit(0), everything, 4).count() == 0
    assert vectors.spherical_kmeans(everything, 2).count() == 21
    assert vectors.diverse(everything.where("id < 21"), 5).count() == 5


def test_metrics(spark):
    hits = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 20, 1), (2, 21, 3)], "query_id int, id int, rank int")
    rel = spark.createDataFrame([(1, 11), (2, 99)], "query_id int, id int")
    got = {(r.metric, r.k): r.value for r in metrics.ir_metrics(hits, rel).collect()}
    assert got["mrr", 1] == 0.0 and got["mrr", 3] == 0.25 and got["recall", 3] == 0.5 and got["ndcg", 3] == pytest.approx(0.5 / 1.584963, abs=1e-6)
    r = spark.createDataFrame([("1", ["1", "2"]), ("2", ["1", "2"]), ("3", None), (None, ["1"])], "r string, l array<string>").select(metrics.hit_at(F.col("r"), F.col("l"), 1), metrics.hit_at(F.col("r"), F.col("l"), 2)).collect()
    assert [tuple(x) for x in r] == [(1, 1), (0, 1), (0, 0), (None, None)]
    c = metrics.correlations(spark.createDataFrame([(float(i % 4), float(i * i)) for i in range(12)], "a double, b double"), "a", "b").head()
    assert c.spearman == pytest.approx(0.323875, abs=1e-6)
    assert metrics.corpus_bleu(spark.createDataFrame([("a b c d e", "a b c d e")], "h string, r string"), "h", "r").head().bleu == 1.0


def test_chunking(spark):
    text = " ".join(f"La frase {i} trata de {'agua' if i < 30 else 'torres'} y más cosas." for i in range(60))
    for rule in chunking.AMOUNTS:
        chunks = chunking.chunk_text(text, rule=rule, most=60, slack=10)
        assert " ".join(chunks).split() == text.split() and all(chunking.tokens_of(c) <= 70 for c in chunks)
    assert chunking.chunk_text("palabra " * 300, most=50, slack=5)[0].count("palabra") == 55
    assert chunking.chunk_text("") == [] and chunking.chunk_text("Una. Dos.") == ["Una. Dos."]
    df = spark.createDataFrame([(1, "s", text), (2, "s", None), (3, None, " ")], "doc_id int, source string, text string")
    assert {r.id_document for r in chunking.semantic_chunks(df, "source", "doc_id", "text").collect()} == {"1"}
    assert [r.chunk for r in chunking.fixed_chunks(df.limit(1), "doc_id", "text", 1000).orderBy("chunk_no").collect()] == [text[:1000], text[1000:2000], text[2000:]]
    context = chunking.sentence_context(spark.createDataFrame([(1, "A. B. C.")], "doc_id int, text string"), "doc_id", "text").orderBy("n").collect()
    assert [r.context for r in context] == ["A. B.", "A. B. C.", "B. C."]


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "agua agua río"), (2, "agua torre"), (3, None)], "id int, text string")
    counted = tfidf.terms(df, "id", "text", [])
    assert rows(tfidf.vocabulary(counted, 1, 2)) == [("agua", 2, 3), ("torre", 1, 1)]
    w = tfidf.vectors(counted, tfidf.vocabulary(counted, 1, 10), 3).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("l")).collect()
    assert all(r.l == pytest.approx(1, abs=1e-4) for r in w)
