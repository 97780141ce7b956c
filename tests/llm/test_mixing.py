from __future__ import annotations

from collections import Counter

from acequia.llm import mixing

DOC = "doc_id bigint, text string, source string, tokens string, bucket string, position string"
TARGET = "source string, target_share double, max_passes int, passes string"


def frames(spark):
    docs = [(i, "a b c d e", " Grande" if i % 2 else "grande", "", "", "") for i in range(300)]
    docs += [(1000 + i, "a b c d", "Chica", "", "", "") for i in range(20)] + [(1000, "a b c d", "Chica", "", "", "")]
    docs += [(2000, None, "nada", "", "", ""), (2001, "  ", "nada", "", "", ""), (3000, "x", None, "", "", ""), (4000, "z " * 900, "otra", "", "", "")]
    targets = [("GRANDE ", 0.5, 1, ""), ("chica", 0.2, 3, ""), ("nada", 0.1, 2, ""), ("falta", 0.1, 2, ""), ("unknown", None, None, "")]
    return spark.createDataFrame(docs, DOC), spark.createDataFrame(targets, TARGET)


def test_report(spark):
    docs, targets = frames(spark)
    out = {r.source: r for r in mixing.mix_report(docs, targets, block_tokens=16).collect()}
    total = 1500 + 80 + 1
    assert {s: (r.passes, r.falls_short) for s, r in out.items()} == {"grande": (1, 0), "chica": (3, 1), "nada": (0, 1), "falta": (0, 1), "unknown": (0, 0)}
    assert out["chica"].mixed_tokens == 240 and 0 <= out["grande"].mixed_tokens - total / 2 < 5
    emitted = Counter()
    for r in mixing.mix(docs, targets, block_tokens=16).collect():
        emitted[r.source] += r.tokens
    assert {s: r.mixed_tokens for s, r in out.items()} == {s: emitted[s] for s in out}
    assert abs(sum(r.mixed_share for r in out.values()) - 1) < 1e-9


def test_mix(spark):
    docs, targets = frames(spark)
    rows = mixing.mix(docs, targets, block_tokens=16).orderBy("position", "start").collect()
    used = Counter((r.source, r.doc_id) for r in rows)
    assert max(n for (s, _), n in used.items() if s == "grande") == 1
    assert all(n == 3 for (s, _), n in used.items() if s == "chica") and len([1 for s, _ in used if s == "chica"]) == 20
    half = rows[: len(rows) // 2]
    assert 0.15 < sum(r.tokens for r in half if r.source == "chica") / sum(r.tokens for r in half) < 0.33
    again = mixing.mix(docs, targets, block_tokens=16).orderBy("position", "start").collect()
    assert rows == again


def test_schedule_is_even_and_whole(spark):
    plan = spark.createDataFrame([("a", 700), ("b", 250), ("c", 50), ("d", 0)], "source string, slots bigint")
    one = mixing.schedule(plan).orderBy("position").collect()
    small = mixing.schedule(plan, chunk=37).orderBy("position").collect()
    assert one == small
    for s, n in (("a", 700), ("b", 250), ("c", 50)):
        assert sorted(r["rank"] for r in one if r.source == s) == list(range(n))
    first = [r.source for r in one[:100]]
    assert 64 <= first.count("a") <= 76 and 3 <= first.count("c") <= 7


def test_empty(spark):
    docs, targets = frames(spark)
    assert mixing.mix_report(docs.limit(0), targets).where("passes > 0").count() == 0
    assert mixing.mix_report(docs, targets.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0), targets).count() == 0


def test_buckets_cover_each_source(spark):
    docs, targets = frames(spark)
    sized = mixing.listed_documents(docs, targets)
    plan = mixing.mix_plan(sized, targets, 16)
    rows = mixing.shuffled_blocks(sized, plan, 16, 7, bucket_docs=9).where("source = 'grande'").orderBy("start").collect()
    assert [r.start for r in rows] == list(range(0, 1500, 5))
