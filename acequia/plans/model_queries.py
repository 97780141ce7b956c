"""Queries of preference pairs, conversations, annotations, vectors and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from acequia.functions import measures
from acequia.operators import aggregates, annotation, metrics, preferences, projection, vectors
from acequia.plans.text_queries import read, tokens_sql
from acequia.session import spread


def _pairs(spark, d):
    return read(spark, d, "preferences")


def preference_reject(spark, d):
    rows = preferences.measured(_pairs(spark, d))
    return rows.select("sample_id", "chosen_tokens", "rejected_tokens", F.round("length_ratio", 6).alias("length_ratio"), F.array_join(preferences.reject_reasons(chrf=None, bleu=None), ",").alias("reasons"))


def preference_reject_measured(spark, d):
    rows = preferences.measured(spread(_pairs(spark, d).select("sample_id", "prompt", "chosen", "rejected")))
    return rows.select("sample_id", F.round("chrf", 6).alias("chrf"), F.round("bleu", 6).alias("bleu"), F.array_join(preferences.reject_reasons(), ",").alias("reasons"))


def _rejected(spark, d):
    rows = preferences.measured(_pairs(spark, d)).select("sample_id", "prompt", "chosen", preferences.reject_reasons(chrf=None, bleu=None).alias("reasons"))
    return preferences.with_duplicates(rows, ["sample_id"])


def preference_dedup(spark, d):
    return _rejected(spark, d).select("sample_id", F.array_join("reasons", ",").alias("reasons"))


def preference_pair_dedup(spark, d):
    rows = preferences.measured(_pairs(spark, d)).select("sample_id", "prompt", "chosen", preferences.reject_reasons(chrf=None, bleu=None).alias("reasons"))
    return preferences.with_duplicates(rows, ["sample_id"], by_prompt=False).select("sample_id", F.array_join("reasons", ",").alias("reasons"))


def preference_summary(spark, d):
    return aggregates.reason_summary(_rejected(spark, d).withColumn("month", F.lit("all rows")), "month")


def preference_audit(spark, d):
    return aggregates.distribution(preferences.measured(_pairs(spark, d)).where("chosen <> '' and rejected <> ''"), "length_ratio")


def segment_scores(spark, d):
    rows = spread(_pairs(spark, d).where("chosen is not null and rejected is not null").select("sample_id", "chosen", "rejected"))
    return rows.select("sample_id", F.round(measures.chrf_column("chosen", "rejected"), 6).alias("chrf"), F.round(measures.bleu_column("chosen", "rejected"), 6).alias("bleu"))


def overlap_scores(spark, d):
    rows = spread(_pairs(spark, d).where("chosen is not null and rejected is not null").select("sample_id", "chosen", "rejected")).select("sample_id", measures.overlap_columns("chosen", "rejected").alias("s"))
    return rows.select("sample_id", *[F.round(f"s.{n}", 6).alias(n) for n in ("rouge_1", "rouge_2", "rouge_l", "ter", "meteor")])


def corpus_bleu(spark, d):
    return metrics.corpus_bleu(_pairs(spark, d).where("chosen is not null and rejected is not null"), "chosen", "rejected")


def near_dup_pairs(spark, d):
    return preferences.near_pairs(_pairs(spark, d), "sample_id")


def judge_pairs(spark, d):
    rows = read(spark, d, "responses").where("response is not null")
    out = preferences.judge_pairs(rows.where("model = 'bruma-2b'"), rows.where("model = 'garza-7b'"), "prompt_id", ["created_at"], "response")
    return out.select("prompt_id", F.md5("first").alias("first"), F.md5("second").alias("second"), "swapped")


def judged_pairs(spark, d):
    rows = read(spark, d, "responses").where("response is not null")
    pairs = preferences.judge_pairs(rows.where("model = 'bruma-2b'"), rows.where("model = 'garza-7b'"), "prompt_id", ["created_at"], "response")
    verdict = pairs.withColumn("winner", F.when(F.length("first") > F.length("second"), "A").when(F.length("first") < F.length("second"), "b").otherwise("tie")).withColumn("confidence", F.lit(7))
    return preferences.judged(verdict, "winner", "confidence", 5).select("prompt_id", F.md5("chosen").alias("chosen"), F.md5("rejected").alias("rejected"))


def _turns(spark, d):
    there = read(spark, d, "responses").where("prompt is not null and response is not null")
    return there.select("prompt_id", "model", projection.fold_conversation(F.col("system_prompt"), F.col("prompt"), F.col("response")).alias("conversations"))


def conversation_fold(spark, d):
    return _turns(spark, d).select("prompt_id", "model", F.md5(F.to_json("conversations")).alias("turns"), F.size("conversations").alias("n_turns")).distinct()


def conversation_unfold(spark, d):
    back = _turns(spark, d).select("prompt_id", "model", projection.unfold_conversation(F.col("conversations")).alias("c"))
    return back.select("prompt_id", "model", "c.system_prompt", "c.question", F.md5("c.response").alias("response")).distinct()


def instruction_texts(spark, d):
    text = projection.instruction_text(F.col("system_prompt"), F.col("prompt"), F.col("response"))
    return read(spark, d, "responses").select("prompt_id", "model", F.md5(text).alias("instruction")).distinct()


def bidirectional_pairs(spark, d):
    out = projection.both_directions(read(spark, d, "parallel_biomedical").select("pair_id", "text_es", "text_en"), "text_es", "text_en")
    return out.select("pair_id", "direction", F.md5("source_text").alias("source_text"), F.md5("target_text").alias("target_text"))


def question_fan_out(spark, d):
    rows = read(spark, d, "eval_items").groupBy("id_passage").agg(F.array_sort(F.collect_list("question")).alias("questions"))
    return projection.fan_out(rows, "questions", "id_passage", 2)


def _lists(spark, d):
    by = _pairs(spark, d).where("prompt is not null").groupBy("prompt").agg(F.array_sort(F.collect_set("chosen")).alias("positives"), F.array_sort(F.collect_set("rejected")).alias("negatives"))
    return by.select(F.md5("prompt").alias("prompt"), F.transform("positives", F.md5).alias("positives"), F.transform("negatives", F.md5).alias("negatives"))


def conversation_flatten(spark, d):
    return projection.contrastive_rows(_lists(spark, d), "prompt", "positives", "negatives")


def contrastive_triplets(spark, d):
    return projection.triplets(_lists(spark, d), "prompt", "positives", "negatives")


def question_tables(spark, d):
    return projection.queries_and_passages(read(spark, d, "eval_items"), "item_id", "question", "id_passage", "passage", "answer")["references"]


def chunk_names(spark, d):
    rows = read(spark, d, "documents")
    return rows.select("doc_id", projection.chunk_ids(F.coalesce("source", F.lit("none")), F.coalesce("title", F.lit("")), F.col("doc_id")).alias("id_chunk"))


def flat_columns(spark, d):
    return projection.flat_as_text(read(spark, d, "documents").select("doc_id", "n_chars", "lang"))


def negatives_by_query(spark, d):
    out = annotation.negatives_by_query(_pairs(spark, d).select("sample_id", "prompt", "chosen", "rejected"), "prompt", "chosen", "rejected", "sample_id")
    return out.select(F.md5("prompt").alias("query"), F.md5("passage").alias("passage"), F.md5(F.array_join("negatives", "|")).alias("negatives"))


def _events(spark, d):
    return read(spark, d, "events")


def last_value_pivot(spark, d):
    return annotation.last_value_pivot(_events(spark, d), ["user_id"], "event_type", "value", "event_id", ["click", "error", "purchase"])


def vote_pivot(spark, d):
    return annotation.vote_pivot(_events(spark, d), "user_id", F.col("event_type") == "purchase")


def majority_vote(spark, d):
    return annotation.majority(_events(spark, d).withColumn("item", F.floor(F.col("event_id") / 5).cast("bigint")), "item", "event_type", "event_id")


def fleiss_kappa(spark, d):
    return annotation.fleiss_kappa(_events(spark, d).withColumn("item", F.floor(F.col("event_id") / 5).cast("bigint")), "item", "event_type", 5)


def gold_check(spark, d):
    rows = _events(spark, d).withColumn("item", (F.col("event_id") % 100).cast("bigint"))
    gold = rows.groupBy("item").agg(F.min_by("event_type", "event_id").alias("truth")).where("item < 10")
    return annotation.gold_check(rows, gold, "item", "user_id", "event_type", "truth")


def label_agreement(spark, d):
    rows = _events(spark, d).select(F.col("event_type").alias("a"), F.when(F.get_json_object("props", "$.k").cast("int") < 50, F.col("event_type")).otherwise(F.lit("view")).alias("b"))
    return annotation.agreement_scores(rows, "a", "b")


def _index(spark, d):
    return vectors.index(read(spark, d, "embeddings"))


def _hits(spark, d, k: int):
    """Nearest rows of every row whose id is divisible by 100, against all rows."""
    everything = _index(spark, d)
    return vectors.top_k(everything.where("id % 100 = 0"), everything, k)


def vector_topk(spark, d):
    return _hits(spark, d, 10).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def vector_topk_l2(spark, d):
    everything = vectors.index(read(spark, d, "embeddings"), metric="l2")
    hits = vectors.top_k(everything.where("id % 100 = 0"), everything, 5, metric="l2")
    return hits.select("query_id", "id", F.round(measures.confidence_of_distance(-F.col("score"), "l2"), 5).alias("confidence"), "rank")


def persona_top5(spark, d):
    return vectors.retrieved(_hits(spark, d, 5)).select("query_id", F.array_join("ids", ",").alias("ids"))


def hard_negatives(spark, d):
    pos = _hits(spark, d, 1).select("query_id", "id", "score")
    out = vectors.hard_negatives(_hits(spark, d, 50), pos)
    return out.select("query_id", "id", F.round("score", 6).alias("score"), "place")


def _relevant(spark, d):
    rows = read(spark, d, "embeddings").select("vec_id", "label")
    q = rows.where("vec_id % 100 = 0").toDF("query_id", "label")
    return q.join(rows.toDF("id", "label"), "label").where("id <> query_id").select("query_id", "id")


def ir_metrics(spark, d):
    return metrics.ir_metrics(_hits(spark, d, 20), _relevant(spark, d))


def hit_at_k(spark, d):
    lists = vectors.retrieved(_hits(spark, d, 10))
    first = _relevant(spark, d).groupBy("query_id").agg(F.min("id").alias("reference"))
    return lists.join(first, "query_id").select("query_id", metrics.hit_at(F.col("reference"), F.col("ids"), 1).alias("hit_1"), metrics.hit_at(F.col("reference"), F.col("ids"), 10).alias("hit_10"))


def score_correlation(spark, d):
    return metrics.correlations(_events(spark, d).select("value", F.get_json_object("props", "$.k").cast("double").alias("k")), "value", "k")


def vector_norms(spark, d):
    v = F.col("embedding")
    return read(spark, d, "embeddings").select("vec_id", F.round(measures.norm(v), 6).alias("norm"), F.round(measures.norm(measures.normalised(v)), 6).alias("unit"))


def spherical_kmeans(spark, d):
    return vectors.spherical_kmeans(_index(spark, d), 10).select("id", "cluster")


def pca_2d(spark, d):
    return vectors.project(_index(spark, d)).select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def diverse_selection(spark, d):
    return vectors.diverse(_index(spark, d), 25)


_N = lambda c: rf"trim(regexp_replace(coalesce({c}, ''), '[\s\x0b\x85\p{{Z}}]+', ' ', 'g'), ' ')"
_MEASURED = f"""n AS (SELECT sample_id, {_N('prompt')} AS prompt, {_N('chosen')} AS chosen, {_N('rejected')} AS rejected FROM preferences),
  m AS (SELECT *, {tokens_sql('chosen')} AS ct, {tokens_sql('rejected')} AS rt FROM n), x AS (SELECT *, ct / greatest(rt, 1) AS ratio FROM m),
  r AS (SELECT *, CASE WHEN prompt = '' OR chosen = '' OR rejected = '' THEN concat_ws(',', CASE WHEN prompt = '' THEN 'empty_prompt' END, CASE WHEN chosen = '' THEN 'empty_chosen' END, CASE WHEN rejected = '' THEN 'empty_rejected' END)
    ELSE concat_ws(',', CASE WHEN rt < 20 THEN 'short_rejected' END, CASE WHEN ratio < 0.25 THEN 'length_ratio_too_low' END, CASE WHEN ratio > 4 THEN 'length_ratio_too_high' END) END AS reasons FROM x)"""
_DEDUP = f"""{_MEASURED}, f AS (SELECT prompt, min(sample_id) AS first, arg_min(chosen, sample_id) AS chosen FROM r WHERE reasons = '' GROUP BY 1),
  d AS (SELECT r.sample_id, CASE WHEN reasons = '' AND r.sample_id <> f.first THEN CASE WHEN r.chosen = f.chosen THEN 'duplicate_prompt_chosen' ELSE 'duplicate_prompt' END ELSE reasons END AS reasons FROM r LEFT JOIN f USING (prompt))"""
_SWAP = "CAST(('0x' || substr(md5('42|' || prompt_id), 1, 1))::INTEGER % 2 = 1 AS BOOLEAN)"
_BOTH = f"""l AS (SELECT prompt_id, model, response FROM responses WHERE response IS NOT NULL QUALIFY row_number() OVER (PARTITION BY prompt_id, model ORDER BY created_at DESC, response DESC) = 1),
  j AS (SELECT a.prompt_id, a.response AS a, b.response AS b, {_SWAP.replace('prompt_id', 'a.prompt_id')} AS swapped FROM l a JOIN l b ON a.prompt_id = b.prompt_id AND a.model = 'bruma-2b' AND b.model = 'garza-7b'),
  p AS (SELECT prompt_id, CASE WHEN swapped THEN b ELSE a END AS first, CASE WHEN swapped THEN a ELSE b END AS second, swapped FROM j)"""
_LISTS = """l AS (SELECT md5(prompt) AS prompt, list_transform(list_sort(list_distinct(list(chosen))), lambda x: md5(x)) AS pos, list_transform(list_sort(list_distinct(list(rejected))), lambda x: md5(x)) AS neg FROM preferences p WHERE prompt IS NOT NULL GROUP BY p.prompt)"""
_VEC = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
_HITS = f"""{_VEC}, s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, round(list_cosine_similarity(q.e, c.e), 9) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
  h AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM s)"""
_REL = "rel AS (SELECT q.vec_id AS query_id, c.vec_id AS id FROM v q JOIN v c ON q.label = c.label AND q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)"

ORACLES = {
    "preference_reject": f"WITH {_MEASURED} SELECT sample_id, ct AS chosen_tokens, rt AS rejected_tokens, round(ratio, 6) AS length_ratio, reasons FROM r",
    "preference_dedup": f"WITH {_DEDUP} SELECT sample_id, reasons FROM d",
    "preference_pair_dedup": f"WITH {_MEASURED}, f AS (SELECT prompt, chosen, min(sample_id) AS first FROM r WHERE reasons = '' GROUP BY 1, 2) SELECT r.sample_id, CASE WHEN reasons = '' AND r.sample_id <> f.first THEN 'duplicate_prompt_chosen' ELSE reasons END AS reasons FROM r LEFT JOIN f USING (prompt, chosen)",
    "preference_summary": f"WITH {_DEDUP}, o AS (SELECT unnest(string_split(reasons, ',')) AS reason FROM d WHERE reasons <> '') SELECT f AS file, reason, count(*) AS n FROM o, (VALUES ('ALL'), ('all rows')) x(f) GROUP BY 1, 2",
    "preference_audit": f"WITH {_MEASURED} SELECT count(*) AS n, round(min(ratio), 6) AS min, round(quantile_cont(ratio, 0.25), 6) AS p25, round(median(ratio), 6) AS median, round(avg(ratio), 6) AS mean, round(quantile_cont(ratio, 0.75), 6) AS p75, round(quantile_cont(ratio, 0.95), 6) AS p95, round(max(ratio), 6) AS max FROM x WHERE chosen <> '' AND rejected <> ''",
    "judge_pairs": f"WITH {_BOTH} SELECT prompt_id, md5(first) AS first, md5(second) AS second, swapped FROM p",
    "judged_pairs": f"WITH {_BOTH} SELECT prompt_id, md5(CASE WHEN length(first) > length(second) THEN first ELSE second END) AS chosen, md5(CASE WHEN length(first) > length(second) THEN second ELSE first END) AS rejected FROM p WHERE length(first) <> length(second)",
    "conversation_fold": """SELECT DISTINCT prompt_id, model, md5(CAST(to_json([{'from': 'system', 'value': ''}, {'from': 'human', 'value': prompt}, {'from': 'gpt', 'value': response}]) AS VARCHAR)) AS turns, 3 AS n_turns FROM responses WHERE prompt IS NOT NULL AND response IS NOT NULL""",
    "conversation_unfold": "SELECT DISTINCT prompt_id, model, '' AS system_prompt, prompt AS question, md5(response) AS response FROM responses WHERE prompt IS NOT NULL AND response IS NOT NULL",
    "instruction_texts": "SELECT DISTINCT prompt_id, model, md5(system_prompt || chr(10) || prompt || chr(10) || response) AS instruction FROM responses",
    "bidirectional_pairs": "SELECT pair_id, 'text_es>text_en' AS direction, md5(text_es) AS source_text, md5(text_en) AS target_text FROM parallel_biomedical UNION ALL SELECT pair_id, 'text_en>text_es', md5(text_en), md5(text_es) FROM parallel_biomedical",
    "question_fan_out": "SELECT id_passage || '_' || n AS id_passage, question AS item FROM (SELECT id_passage, question, row_number() OVER (PARTITION BY id_passage ORDER BY question) AS n FROM eval_items WHERE question IS NOT NULL) WHERE n <= 2",
    "conversation_flatten": f"WITH {_LISTS} SELECT prompt AS query, unnest(pos) AS passage, 1 AS label FROM l UNION ALL SELECT prompt, unnest(neg), 0 FROM l",
    "contrastive_triplets": f"WITH {_LISTS} SELECT prompt AS query, pos[1] AS positive, neg[1] AS negative FROM l WHERE pos[1] IS NOT NULL AND neg[1] IS NOT NULL",
    "question_tables": "SELECT item_id AS id_query, id_passage, coalesce(answer, '') AS reference FROM eval_items WHERE trim(question) <> '' AND trim(passage) <> ''",
    "chunk_names": r"SELECT doc_id, replace(string_split(coalesce(source, 'none'), '\')[-1], ' ', '_') || '-' || replace(string_split(coalesce(title, ''), '\')[-1], ' ', '_') || '-' || doc_id AS id_chunk FROM documents",
    "flat_columns": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(n_chars AS VARCHAR) AS n_chars, lang FROM documents",
    "negatives_by_query": "SELECT md5(prompt) AS query, md5(arg_min(chosen, sample_id)) AS passage, md5(coalesce(array_to_string(list(rejected ORDER BY sample_id) FILTER (trim(rejected) <> ''), '|'), '')) AS negatives FROM preferences WHERE trim(prompt) <> '' AND trim(chosen) <> '' GROUP BY prompt",
    "last_value_pivot": "SELECT user_id, " + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{t}') AS {t}" for t in ("click", "error", "purchase")) + " FROM events WHERE value IS NOT NULL GROUP BY 1",
    "vote_pivot": "SELECT user_id, count(*) FILTER (event_type = 'purchase') AS votes_for, count(*) FILTER (event_type <> 'purchase') AS votes_against FROM events GROUP BY 1",
    "majority_vote": """
      WITH e AS (SELECT event_id // 5 AS item, event_type, event_id FROM events WHERE event_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id // 5 ORDER BY event_id) <= 3),
        c AS (SELECT item, event_type, count(*) AS n, min(event_id) AS f, sum(count(*)) OVER (PARTITION BY item) AS t FROM e GROUP BY 1, 2)
      SELECT item, event_type AS label, n || '/' || CAST(t AS INTEGER) AS agreement FROM c QUALIFY row_number() OVER (PARTITION BY item ORDER BY n DESC, f) = 1""",
    "fleiss_kappa": """
      WITH b AS (SELECT event_id // 5 AS item, event_type, count(*) AS n FROM events GROUP BY 1, 2), f AS (SELECT item, sum(n * (n - 1)) AS a FROM b GROUP BY 1 HAVING sum(n) = 5),
        o AS (SELECT count(*) AS items, avg(a / 20) AS po FROM f), s AS (SELECT event_type, sum(n) AS n FROM b WHERE item IN (SELECT item FROM f) GROUP BY 1), p AS (SELECT sum(n * n) / (sum(n) * sum(n)) AS pe FROM s)
      SELECT items, round(po, 6) AS observed, round(pe, 6) AS expected, round((po - pe) / (1 - pe), 6) AS kappa FROM o, p""",
    "gold_check": """
      WITH r AS (SELECT event_id % 100 AS item, user_id, event_type, event_id FROM events), g AS (SELECT item, arg_min(event_type, event_id) AS truth FROM r WHERE item < 10 GROUP BY 1),
        c AS (SELECT user_id, count(*) AS n_checked, count(*) FILTER (event_type <> truth) AS n_wrong FROM r JOIN g USING (item) GROUP BY 1)
      SELECT *, round(1 - n_wrong / n_checked, 6) AS accuracy, n_wrong = 0 AS passed FROM c""",
    "label_agreement": """
      WITH r AS (SELECT event_type AS a, CASE WHEN CAST(props ->> '$.k' AS INTEGER) < 50 THEN event_type ELSE 'view' END AS b FROM events),
        l AS (SELECT l, (SELECT count(*) FROM r WHERE a = l) AS x, (SELECT count(*) FROM r WHERE b = l) AS y, (SELECT count(*) FROM r WHERE a = l AND b = l) AS h FROM (SELECT a AS l FROM r UNION SELECT b FROM r)),
        s AS (SELECT sum(x) AS n, sum(h) / sum(x) AS po, sum(x * y) / (sum(x) * sum(x)) AS pe, avg(2 * h / (x + y)) AS f1 FROM l)
      SELECT CAST(n AS BIGINT) AS n, round(po, 6) AS accuracy, round((po - pe) / (1 - pe), 6) AS cohen_kappa, round(f1, 6) AS f1_macro FROM s""",
    "vector_topk": f"WITH {_HITS} SELECT query_id, id, round(score, 6) AS score, rank FROM h WHERE rank <= 10",
    "vector_topk_l2": f"""WITH {_VEC}, s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, round(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) AS dist FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
      h AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS INTEGER) AS rank FROM s) SELECT query_id, id, round(1 / (1 + dist), 5) AS confidence, rank FROM h WHERE rank <= 5""",
    "persona_top5": f"WITH {_HITS} SELECT query_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY rank) AS ids FROM h WHERE rank <= 5 GROUP BY 1",
    "hard_negatives": f"""WITH {_HITS}, p AS (SELECT query_id, id, score AS positive FROM h WHERE rank = 1),
      n AS (SELECT h.query_id, h.id, score, CAST(row_number() OVER (PARTITION BY h.query_id ORDER BY score DESC, h.id) AS INTEGER) AS place FROM h JOIN p USING (query_id) WHERE rank BETWEEN 10 AND 49 AND score <= 0.8 AND score <= positive * 0.95 AND h.id <> p.id)
      SELECT query_id, id, round(score, 6) AS score, place FROM n WHERE place <= 5""",
    "ir_metrics": f"""WITH {_HITS}, {_REL}, n AS (SELECT query_id, count(*) AS n_rel FROM rel GROUP BY 1), g AS (SELECT h.query_id, rank, row_number() OVER (PARTITION BY h.query_id ORDER BY rank) AS seen FROM h JOIN rel USING (query_id, id) WHERE rank <= 20),
      k AS (SELECT unnest([1, 3, 5, 10, 20]) AS k),
      q AS (SELECT n.query_id, k, n_rel, coalesce(sum(1 / log2(rank + 1)) FILTER (rank <= k), 0) / list_sum(list_transform(range(1, least(n_rel, k) + 1), lambda i: 1 / log2(i + 1.0))) AS ndcg, coalesce(sum(seen / rank) FILTER (rank <= k), 0) / least(n_rel, k) AS map,
        coalesce(max(1 / rank) FILTER (rank <= k), 0) AS mrr, count(rank) FILTER (rank <= k) / n_rel AS recall, count(rank) FILTER (rank <= k) / k AS precision FROM n CROSS JOIN k LEFT JOIN g USING (query_id) GROUP BY 1, 2, 3)
      SELECT metric, k, round(avg(v), 6) AS value FROM (SELECT k, unnest([{{'m': 'ndcg', 'v': ndcg}}, {{'m': 'map', 'v': map}}, {{'m': 'mrr', 'v': mrr}}, {{'m': 'recall', 'v': recall}}, {{'m': 'precision', 'v': precision}}]) AS s FROM q) CROSS JOIN LATERAL (SELECT s.m AS metric, s.v AS v) GROUP BY 1, 2""",
    "hit_at_k": f"WITH {_HITS}, {_REL}, f AS (SELECT query_id, min(id) AS reference FROM rel GROUP BY 1) SELECT query_id, CAST(bool_or(id = reference AND rank <= 1) AS INTEGER) AS hit_1, CAST(bool_or(id = reference AND rank <= 10) AS INTEGER) AS hit_10 FROM h JOIN f USING (query_id) GROUP BY 1",
    "score_correlation": """WITH r AS (SELECT value AS a, CAST(props ->> '$.k' AS DOUBLE) AS b FROM events), s AS (SELECT a, b, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb FROM r WHERE a IS NOT NULL AND b IS NOT NULL)
      SELECT round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM s""",
    "vector_norms": f"WITH {_VEC} SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS norm, CASE WHEN list_dot_product(e, e) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS unit FROM v",
}

QUERIES = {
    f.__name__: f
    for f in (
        preference_reject, preference_reject_measured, preference_dedup, preference_pair_dedup, preference_summary, preference_audit, segment_scores, overlap_scores, corpus_bleu, near_dup_pairs, judge_pairs, judged_pairs,
        conversation_fold, conversation_unfold, instruction_texts, bidirectional_pairs, question_fan_out, conversation_flatten, contrastive_triplets, question_tables, chunk_names, flat_columns,
        negatives_by_query, last_value_pivot, vote_pivot, majority_vote, fleiss_kappa, gold_check, label_agreement, vector_topk, vector_topk_l2, persona_top5, hard_negatives, ir_metrics, hit_at_k,
        score_correlation, vector_norms, spherical_kmeans, pca_2d, diverse_selection,
    )
}
