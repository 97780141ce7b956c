"""Queries of sampling, de-duplication, joins and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from acequia.functions.text import clean, shuffle_key
from acequia.operators import aggregates, dedup, filters, joins, minhash, projection, sampling
from acequia.operators.ordering import running
from acequia.plans.text_queries import clean_sql, counted, docs, read, tokens_sql
from acequia.session import checkpoint_root
from acequia.sources import readers, writers

SEED = 42
TARGETS = {"Boletin_Sierra_Norte": 5000, "Pliegos_Menores": 2000, "No_Existe": 10}
LANGUAGES = {"es": 20000, "en": 500}


def sample_tokens_stratified(spark, d):
    return sampling.tokens_stratified(counted(spark, d), 50_000).select("doc_id", "source", "tokens")


def sample_tokens_equal(spark, d):
    return sampling.tokens_equal(counted(spark, d), 2_000).select("doc_id", "source", "tokens")


def sample_tokens_per_source(spark, d):
    return sampling.tokens_by_group(counted(spark, d), TARGETS).select("doc_id", "source", "tokens")


def sample_docs_stratified(spark, d):
    return sampling.rows_stratified(docs(spark, d), 333).select("doc_id", "source")


def sample_docs_equal(spark, d):
    return sampling.perform("downsampling-documents-general-equitative", docs(spark, d), each=7).select("doc_id", "source")


def sample_docs_per_source(spark, d):
    return sampling.rows_by_group(docs(spark, d), {k: v // 100 for k, v in TARGETS.items()}).select("doc_id", "source")


def sample_category_tokens(spark, d):
    return sampling.category_share(counted(spark, d), 60_000, True, "lang", "doc_id").select("doc_id", "lang")


def sample_category_rows(spark, d):
    return sampling.category_share(docs(spark, d), 250, False, "lang", "doc_id").select("doc_id", "lang")


def sample_category_specific_tokens(spark, d):
    return sampling.category_listed(counted(spark, d), LANGUAGES, True, "lang", "doc_id").select("doc_id", "lang")


def sample_category_specific_rows(spark, d):
    return sampling.category_listed(docs(spark, d), 11, False, "lang", "doc_id").select("doc_id", "lang")


def balanced_eval_sample(spark, d):
    return sampling.balanced(docs(spark, d), 200, "source", "doc_id").select("doc_id", "source")


def running_tokens(spark, d):
    keyed = counted(spark, d).select("doc_id", "source", "tokens", shuffle_key(F.col("doc_id"), SEED).alias("k"))
    return running(keyed, ["source"], "k", ["doc_id"], F.col("tokens"), "upto").select("doc_id", "source", "upto")


def shuffled_order(spark, d):
    keyed = docs(spark, d).select("doc_id", shuffle_key(F.col("doc_id"), SEED).alias("k"))
    return running(keyed, [], "k", ["doc_id"], F.lit(1), "place").select("doc_id", F.col("place").cast("bigint").alias("place"))


def split_fixed(spark, d):
    return sampling.split_sizes(docs(spark, d), "doc_id", {"test": 10, "validation": 50}, "train").select("doc_id", "split")


def split_ratio(spark, d):
    return sampling.split_shares(docs(spark, d), "doc_id", {"train": 0.8, "validation": 0.1}, "test").select("doc_id", "split")


def split_contiguous(spark, d):
    return sampling.contiguous_parts(docs(spark, d).select("doc_id"), ["doc_id"], 7)


def split_by_group(spark, d):
    return sampling.split_groups(docs(spark, d).select("doc_id", "source"), "source", 0.2)


def annotation_blocks(spark, d):
    return sampling.annotation_blocks(docs(spark, d), read(spark, d, "eval_items").select("item_id").where("difficulty = 'media'"), "doc_id")


def topic_quota_sample(spark, d):
    return sampling.topic_quota(docs(spark, d).where("text is not null"), "source", "text", "doc_id", bands=(500, 1500)).select("doc_id", "source")


def topic_sample_trimmed(spark, d):
    rows = docs(spark, d).select("doc_id", "source")
    return sampling.trim_to_total(rows, "source", "doc_id", rows.count() - 15)


def topic_sample_filled(spark, d):
    rows = docs(spark, d).select("doc_id", "source")
    first = sampling.rows_equal(rows, 3)
    return sampling.fill_to_total(first, rows, "source", "doc_id", 200)


def jsonl_roundtrip(spark, d):
    path = f"{checkpoint_root(spark)}/acequia/jsonl-{uuid.uuid4().hex}"
    rows = docs(spark, d).select("doc_id", "text", "source")
    writers.write_twin(rows, path)
    back = readers.jsonl(spark, f"{path}.jsonl", "doc_id bigint, text string, source string")
    return back.select("doc_id", "source", F.md5("text").alias("text_md5"))


def csv_roundtrip(spark, d):
    path = f"{checkpoint_root(spark)}/acequia/csv-{uuid.uuid4().hex}"
    writers.write_csv(read(spark, d, "resources"), path, ["dataset", "reg_date", "domain"])
    return readers.csv(spark, path)


def parts_roundtrip(spark, d):
    path = f"{checkpoint_root(spark)}/acequia/parts-{uuid.uuid4().hex}"
    writers.write_parts(docs(spark, d).select("doc_id", "source"), path, ["doc_id"], 4)
    return readers.parquet_tree(spark, path, ["doc_id", "source"])


def uniform_sample(spark, d):
    return sampling.uniform(docs(spark, d).select("doc_id"), 100, "doc_id")


def random_styles(spark, d):
    return sampling.styles(docs(spark, d).select("doc_id"), ["formal", "breve", "llano"], "doc_id", False)


def all_styles(spark, d):
    return sampling.styles(docs(spark, d).select("doc_id"), ["formal", "breve", "llano"], "doc_id", True)


def exact_dedup_keep_first(spark, d):
    return dedup.text_dedup(docs(spark, d)).select("doc_id")


def duplicate_id_report(spark, d):
    return dedup.duplicate_ids(docs(spark, d))


def duplicate_groups(spark, d):
    return dedup.text_groups(docs(spark, d))


def keyed_dedup(spark, d):
    return dedup.keep_first(docs(spark, d), ["source", "lang"], ["doc_id"]).select("doc_id", "source", "lang")


def text_then_id_dedup(spark, d):
    return dedup.text_then_id_dedup(docs(spark, d).select("doc_id", "text")).select("doc_id")


def duplicate_counters(spark, d):
    return dedup.duplicate_counts(docs(spark, d), F.sha2(F.coalesce("text", F.lit("")), 256))


def fingerprint_report(spark, d):
    return dedup.fingerprint_groups(read(spark, d, "preferences"), ["prompt", "chosen"], "sample_id", 80)


def best_annotation(spark, d):
    rows = read(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return dedup.best_record(rows, ["user_id", "event_type"], F.col("value") > 50, ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def merge_existing_wins(spark, d):
    rows = docs(spark, d).select("doc_id", "source", "lang")
    old, new = rows.where("lang = 'es'"), rows.where("lang <> 'es' or lang is null")
    return dedup.merge_new(old, new, ["source"], ["doc_id"])


def resume_anti_join(spark, d):
    return dedup.unprocessed(read(spark, d, "corpus_rows").select("source_id", "id").distinct(), read(spark, d, "corpus_rows").where("tokens is not null"), ["source_id", "id"])


def append_unique_rows(spark, d):
    rows = docs(spark, d).select("source", "lang")
    return dedup.stack(rows, rows.withColumn("extra", F.lit(1))).distinct()


def widened_union(spark, d):
    return dedup.stack(read(spark, d, "nation").selectExpr("n_nationkey as k"), read(spark, d, "region").selectExpr("r_name as k"), widen=True)


def minhash_dedup(spark, d):
    return minhash.minhash_dedup(docs(spark, d)).select("doc_id")


def minhash_short(spark, d):
    return minhash.minhash_groups(read(spark, d, "preferences"), "prompt", "sample_id", shingle=3, bands=8, rows=8)


def map_source_ids(spark, d):
    mapping = read(spark, d, "resources").where("domain is not null").selectExpr("dataset as original_dataset", "lower(trim(domain)) as mapped_dataset")
    return joins.map_sources(docs(spark, d).selectExpr("doc_id", "source as source_id"), mapping)


def enrich_metadata_json(spark, d):
    meta = projection.to_metadata(docs(spark, d).selectExpr("doc_id", "lang", "doc_date", "n_chars"), ["doc_id"])
    return joins.enrich(docs(spark, d).select("doc_id", "text", "source"), meta, ["doc_id"], ["metadata"]).select("doc_id", "source", "metadata")


def two_key_join(spark, d):
    left = docs(spark, d).selectExpr("doc_id", "lower(trim(source)) as s", "coalesce(lang, 'none') as l")
    right = read(spark, d, "corpus_rows").groupBy(F.lower(F.trim("source_id")).alias("s2")).agg(F.count("*").alias("n_rows")).withColumn("l2", F.lit("es"))
    return joins.two_key(left, right, [("s", "s2"), ("l", "l2")]).select("doc_id", "n_rows")


def counts_attached(spark, d):
    counts = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return joins.with_counts(read(spark, d, "customer").select("c_custkey"), counts, "c_custkey", ["n_orders"])


def answers_of_both(spark, d):
    rows = read(spark, d, "responses").where("response is not null")
    both = joins.answered_by_both(rows.where("model = 'bruma-2b'"), rows.where("model = 'garza-7b'"), "prompt_id", ["created_at", "response"], "response")
    return both.select("prompt_id", F.md5("response_a").alias("a"), F.md5("response_b").alias("b"))


def retrieval_join(spark, d):
    items = read(spark, d, "eval_items")
    parts = projection.queries_and_passages(items, "item_id", "question", "id_passage", "passage", "answer")
    return joins.retrieval_rows(parts["queries"], parts["references"], parts["contexts"]).select("id_query", "id_passage", F.md5("reference").alias("reference"), F.size("reference_contexts").alias("n_contexts"))


def random_distractors(spark, d):
    items = read(spark, d, "eval_items").where("question is not null")
    return joins.distractors(items, read(spark, d, "eval_items"), "item_id", "id_passage", "id_passage", 20)


def stats_grouping_sets(spark, d):
    return aggregates.statistics(counted(spark, d), ["lang", "source"])


def corpus_summary(spark, d):
    return aggregates.source_stats(counted(spark, d))


def domain_rollup(spark, d):
    rows = read(spark, d, "resources").select(F.lower(F.trim("domain")).alias("domain"), F.expr("try_cast(regexp_replace(tokens, '[.,]', '') as bigint)").alias("tokens"), "size_mb")
    return aggregates.domain_rollup(rows, "domain", "tokens", "size_mb")


def registry_upsert(spark, d):
    rows = read(spark, d, "resources").select("dataset", "reg_date", "tokens")
    return aggregates.upsert(rows.where("reg_date like '%/%'"), rows.where("reg_date not like '%/%'"), ["dataset"])


def divisor_values(spark, d):
    return aggregates.values(docs(spark, d), "lang")


def tokens_by_value(spark, d):
    return aggregates.tokens_by_value(counted(spark, d), "lang")


def number_distribution(spark, d):
    return aggregates.distribution(read(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"])


def length_distribution(spark, d):
    return aggregates.distribution(counted(spark, d), "tokens")


def reject_summary(spark, d):
    rows = docs(spark, d).select("source", filters.comment_reasons(F.col("text"), F.col("title"), F.col("url")).alias("reasons"))
    return aggregates.reason_summary(rows, "source")


def kept_summary(spark, d):
    rows = docs(spark, d).select("source", filters.comment_reasons(F.col("text"), F.col("title"), F.col("url")).alias("reasons"))
    return aggregates.kept_summary(rows, "source")


def metric_summary(spark, d):
    return aggregates.metric_summary(read(spark, d, "lineitem").select("l_quantity", "l_discount", F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("l_tax")), ["l_quantity", "l_discount", "l_tax"])


def model_wins(spark, d):
    return aggregates.wins(read(spark, d, "preferences").where("metadata.model_chosen is not null"), F.lower(F.trim("metadata.model_chosen")))


def category_distribution(spark, d):
    return aggregates.distribution_of(read(spark, d, "events").select("event_type"), "event_type")


def cluster_dominance(spark, d):
    return aggregates.cluster_sizes(docs(spark, d).withColumn("c", F.coalesce("lang", F.lit("none"))), "c")


def system_scores(spark, d):
    return aggregates.system_score(read(spark, d, "events"), "value", ["event_type"])


def big_groups(spark, d):
    return dedup.topic_window_size(docs(spark, d).select("doc_id", "source"), "source", 20)


def group_values(spark, d):
    return read(spark, d, "corpus_rows").select("source_id").distinct()


def running_ids(spark, d):
    rows = docs(spark, d).select("doc_id")
    return projection.running_id(rows, F.lit("web"), ["doc_id"])


def cleaned_changes(spark, d):
    c = clean(F.col("text"))
    return docs(spark, d).agg(F.count_if(c != F.col("text")).alias("n_changed"), F.count("*").alias("n_rows"))


_KEY = "md5('42|' || CAST(doc_id AS VARCHAR))"
_T = f"t AS (SELECT doc_id, source, lang, text, title, url, {tokens_sql('text')} AS tokens, {_KEY} AS k FROM documents)"


def _remainder(group: str, size: str, target: int, where: str) -> str:
    """Common table b of (group, budget) by largest remainder."""
    return f"""s AS (SELECT {group} AS g, {size} AS size FROM t WHERE {group} IS NOT NULL GROUP BY 1 {where}),
      e AS (SELECT g, CAST(size AS DOUBLE) / (SELECT sum(size) FROM s) * {target} AS exact FROM s),
      b AS (SELECT g, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, g) <= {target} - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS budget FROM e)"""


def _take(group: str, value: str, columns: str) -> str:
    return f"SELECT {columns} FROM (SELECT t.*, sum({value}) OVER (PARTITION BY t.{group} ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS r, budget FROM t JOIN b ON b.g = t.{group}) WHERE r <= budget"


def _listed(targets: dict[str, int]) -> str:
    return "b AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v})" for k, v in targets.items()) + ") x(g, budget))"


_OTHERS = "UNION ALL SELECT {0} FROM t WHERE source IS NULL OR source NOT IN (" + ", ".join(f"'{k}'" for k in TARGETS) + ")"
_COMMENT = r"""r AS (SELECT source, list_filter([CASE WHEN text IS NULL THEN 'no_text' END, CASE WHEN NOT regexp_matches(text, '[a-záéíóúüñA-ZÁÉÍÓÚÜÑ]') THEN 'no_letter' END,
        CASE WHEN length(trim(regexp_replace(text, 'https?://\S+|www\.\S+', '', 'g'), ' ')) < 30 THEN 'just_url' END, CASE WHEN regexp_matches(text, '(?i)bienvenido') THEN 'welcome' END,
        CASE WHEN regexp_matches(text, '(?i)(listado.*no.repetidas|no.repetidas.*listado|propuestas.*no.repetidas)') THEN 'listing' END,
        CASE WHEN regexp_matches(title, '(?i)#T[uú]Preguntas') THEN 'questions' END, CASE WHEN length(coalesce(url, '')) = 0 THEN 'no_description' END], lambda x: x IS NOT NULL) AS rs FROM documents)"""

ORACLES = {
    "sample_tokens_stratified": f"WITH {_T}, {_remainder('source', 'sum(tokens)', 50_000, 'HAVING sum(tokens) > 0')} {_take('source', 'tokens', 'doc_id, source, tokens')}",
    "sample_tokens_equal": f"WITH {_T}, b AS (SELECT DISTINCT source AS g, 2000 AS budget FROM t) {_take('source', 'tokens', 'doc_id, source, tokens')}",
    "sample_tokens_per_source": f"WITH {_T}, {_listed(TARGETS)} {_take('source', 'tokens', 'doc_id, source, tokens')} {_OTHERS.format('doc_id, source, tokens')}",
    "sample_docs_stratified": f"WITH {_T}, {_remainder('source', 'count(*)', 333, '')} {_take('source', '1', 'doc_id, source')}",
    "sample_docs_equal": f"WITH {_T}, b AS (SELECT DISTINCT source AS g, 7 AS budget FROM t) {_take('source', '1', 'doc_id, source')}",
    "sample_docs_per_source": f"WITH {_T}, {_listed({k: v // 100 for k, v in TARGETS.items()})} {_take('source', '1', 'doc_id, source')} {_OTHERS.format('doc_id, source')}",
    "sample_category_tokens": f"WITH {_T}, s AS (SELECT lang AS g, sum(tokens) AS size FROM t WHERE lang IS NOT NULL GROUP BY 1), b AS (SELECT g, floor(CAST(size AS DOUBLE) / sum(size) OVER () * 60000) AS budget FROM s) {_take('lang', 'tokens', 'doc_id, lang')}",
    "sample_category_rows": f"WITH {_T}, s AS (SELECT lang AS g, count(*) AS size FROM t WHERE lang IS NOT NULL GROUP BY 1), b AS (SELECT g, floor(CAST(size AS DOUBLE) / sum(size) OVER () * 250) AS budget FROM s) {_take('lang', '1', 'doc_id, lang')}",
    "sample_category_specific_tokens": f"WITH {_T}, {_listed(LANGUAGES)} {_take('lang', 'tokens', 'doc_id, lang')}",
    "sample_category_specific_rows": f"WITH {_T}, b AS (SELECT DISTINCT lang AS g, 11 AS budget FROM t) {_take('lang', '1', 'doc_id, lang')}",
    "balanced_eval_sample": f"""WITH {_T}, s AS (SELECT source AS g, count(*) AS size FROM t WHERE source IS NOT NULL GROUP BY 1),
      b AS (SELECT g, least(size, 200 // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY g) <= 200 % count(*) OVER () THEN 1 ELSE 0 END) AS budget FROM s) {_take('source', '1', 'doc_id, source')}""",
    "running_tokens": f"WITH {_T} SELECT doc_id, source, CAST(sum(tokens) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM t",
    "shuffled_order": f"WITH {_T} SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS place FROM t",
    "split_fixed": f"WITH {_T}, r AS (SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS n FROM t) SELECT doc_id, CASE WHEN n <= 10 THEN 'test' WHEN n <= 60 THEN 'validation' ELSE 'train' END AS split FROM r",
    "split_ratio": f"WITH {_T}, r AS (SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS n, count(*) OVER () AS c FROM t) SELECT doc_id, CASE WHEN n <= floor(c * 0.8) THEN 'train' WHEN n <= floor(c * 0.8) + floor(c * 0.1) THEN 'validation' ELSE 'test' END AS split FROM r",
    "split_contiguous": "SELECT doc_id, CAST(least((row_number() OVER (ORDER BY doc_id) - 1) // greatest(1, count(*) OVER () // 7), 6) AS INTEGER) AS part FROM documents",
    "split_by_group": "WITH g AS (SELECT source, row_number() OVER (ORDER BY md5('42|' || source) NULLS FIRST, source) AS n, count(*) OVER () AS c FROM (SELECT DISTINCT source FROM documents)) SELECT doc_id, d.source, CASE WHEN n <= greatest(1, floor(c * 0.2)) THEN 'eval' ELSE 'train' END AS split FROM documents d JOIN g ON d.source IS NOT DISTINCT FROM g.source",
    "annotation_blocks": """
      WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS id, CAST((row_number() OVER (ORDER BY md5('42|' || doc_id), CAST(doc_id AS VARCHAR)) - 1) // 50 AS INTEGER) AS block FROM documents),
        g AS (SELECT block, CAST(item_id AS VARCHAR) AS id FROM (SELECT DISTINCT block FROM r), (SELECT DISTINCT item_id FROM eval_items WHERE difficulty = 'media')
          QUALIFY row_number() OVER (PARTITION BY block ORDER BY md5('42|' || block || '|' || item_id), CAST(item_id AS VARCHAR)) <= 5),
        u AS (SELECT block, id, false AS is_gold FROM r UNION ALL SELECT block, id, true FROM g)
      SELECT block, CAST(row_number() OVER (PARTITION BY block ORDER BY md5('42|place|' || id), id, is_gold) AS INTEGER) AS place, id, is_gold FROM u""",
    "topic_quota_sample": f"""
      WITH {_T}, n AS (SELECT *, count(*) OVER (PARTITION BY source) AS c, CASE WHEN length(text) <= 500 THEN 0 WHEN length(text) <= 1500 THEN 1 ELSE 2 END AS band FROM t WHERE text IS NOT NULL AND source IS NOT NULL),
        f AS (SELECT *, row_number() OVER (PARTITION BY source, band ORDER BY k, doc_id) AS f FROM n WHERE c >= 10),
        o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN f = 1 THEN '000' || band || k ELSE '1' || k END, doc_id) AS r FROM f)
      SELECT doc_id, source FROM o WHERE r <= greatest(least(round(c * 0.33), 50), 3)""",
    "topic_sample_trimmed": f"""
      WITH {_T}, s AS (SELECT source, count(*) AS n, arg_max(doc_id, (k, doc_id)) AS last FROM t GROUP BY 1 HAVING count(*) > 3 ORDER BY n DESC, source LIMIT 15)
      SELECT doc_id, source FROM t WHERE doc_id NOT IN (SELECT last FROM s)""",
    "topic_sample_filled": f"""
      WITH {_T}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) AS n FROM t), s AS (SELECT doc_id, source FROM r WHERE n <= 3 AND source IS NOT NULL),
        x AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) AS m, count(*) OVER (PARTITION BY source) AS c FROM t WHERE doc_id NOT IN (SELECT doc_id FROM s))
      SELECT * FROM s UNION ALL (SELECT doc_id, source FROM x ORDER BY m, c DESC, k, doc_id LIMIT greatest(0, 200 - (SELECT count(*) FROM s)))""",
    "jsonl_roundtrip": "SELECT doc_id, source, md5(text) AS text_md5 FROM documents",
    "csv_roundtrip": "SELECT dataset, reg_date, domain FROM resources",
    "parts_roundtrip": "SELECT doc_id, source FROM documents",
    "uniform_sample": f"WITH {_T} SELECT doc_id FROM t ORDER BY k, doc_id LIMIT 100",
    "random_styles": f"SELECT doc_id, ['formal', 'breve', 'llano'][CAST(('0x' || substr({_KEY}, 1, 8))::BIGINT % 3 + 1 AS INTEGER)] AS style FROM documents",
    "all_styles": "SELECT doc_id, unnest(['formal', 'breve', 'llano']) AS style FROM documents",
    "exact_dedup_keep_first": "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "duplicate_id_report": "SELECT doc_id AS id, min(doc_id) OVER w AS first_id, count(*) OVER w AS copies FROM documents WINDOW w AS (PARTITION BY text) QUALIFY count(*) OVER w > 1",
    "duplicate_groups": "SELECT min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1",
    "keyed_dedup": "SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1",
    "text_then_id_dedup": "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "duplicate_counters": "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups FROM (SELECT count(*) AS n FROM documents GROUP BY coalesce(text, '') HAVING count(*) > 1)",
    "fingerprint_report": r"""
      WITH h AS (SELECT sample_id, array_to_string(regexp_extract_all(lower(coalesce(prompt, '')), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]')[1:80], ' ') AS p,
        array_to_string(regexp_extract_all(lower(coalesce(chosen, '')), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]')[1:80], ' ') AS c FROM preferences)
      SELECT min(sample_id) AS first_id, count(*) AS copies FROM h GROUP BY p, c HAVING count(*) > 1""",
    "best_annotation": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY NOT coalesce(value > 50, false), ts, event_id) = 1",
    "merge_existing_wins": """WITH o AS (SELECT doc_id, source, lang FROM documents WHERE lang = 'es'), n AS (SELECT doc_id, source, lang FROM documents WHERE lang <> 'es' OR lang IS NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1)
      SELECT * FROM o UNION ALL SELECT * FROM n WHERE source NOT IN (SELECT source FROM o)""",
    "resume_anti_join": "SELECT DISTINCT source_id, id FROM corpus_rows c WHERE NOT EXISTS (SELECT 1 FROM corpus_rows x WHERE x.tokens IS NOT NULL AND x.source_id = c.source_id AND x.id = c.id)",
    "append_unique_rows": "SELECT DISTINCT source, lang, CAST(NULL AS INTEGER) AS extra FROM documents UNION ALL SELECT DISTINCT source, lang, 1 FROM documents",
    "widened_union": "SELECT CAST(n_nationkey AS VARCHAR) AS k FROM nation UNION ALL SELECT r_name FROM region",
    "map_source_ids": "WITH m AS (SELECT dataset, min(lower(trim(domain))) AS d FROM resources WHERE domain IS NOT NULL GROUP BY 1) SELECT doc_id, coalesce(d, source) AS source_id FROM documents LEFT JOIN m ON dataset = source",
    "enrich_metadata_json": "SELECT doc_id, source, CAST(to_json({lang: lang, doc_date: doc_date, n_chars: n_chars}) AS VARCHAR) AS metadata FROM documents WHERE text IS NOT NULL",
    "two_key_join": "WITH r AS (SELECT lower(trim(source_id)) AS s2, count(*) AS n_rows FROM corpus_rows GROUP BY 1) SELECT doc_id, n_rows FROM documents LEFT JOIN r ON lower(trim(source)) = s2 AND coalesce(lang, 'none') = 'es'",
    "counts_attached": "SELECT c_custkey, count(o_custkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "answers_of_both": """WITH r AS (SELECT prompt_id, model, response FROM responses WHERE response IS NOT NULL QUALIFY row_number() OVER (PARTITION BY prompt_id, model ORDER BY created_at DESC, response DESC) = 1)
      SELECT a.prompt_id, md5(a.response) AS a, md5(b.response) AS b FROM r a JOIN r b ON a.prompt_id = b.prompt_id AND a.model = 'bruma-2b' AND b.model = 'garza-7b'""",
    "retrieval_join": "SELECT item_id AS id_query, id_passage, md5(coalesce(answer, '')) AS reference, 1 AS n_contexts FROM eval_items WHERE trim(question) <> '' AND trim(passage) <> ''",
    "stats_grouping_sets": f"""
      WITH {_T} SELECT CASE grouping(lang, source) WHEN 3 THEN 'overall' WHEN 1 THEN 'lang' WHEN 2 THEN 'source' ELSE 'lang-source' END AS statistic_type,
        CASE grouping(lang, source) WHEN 3 THEN 'all' WHEN 1 THEN coalesce(lang, 'null') WHEN 2 THEN coalesce(source, 'null') ELSE coalesce(lang, 'null') || '-' || coalesce(source, 'null') END AS category,
        count(*) AS n_rows, CAST(sum(tokens) AS BIGINT) AS total_tokens, round(avg(tokens), 6) AS avg_tokens FROM t GROUP BY GROUPING SETS ((), (lang), (source), (lang, source))""",
    "corpus_summary": f"WITH {_T}, s AS (SELECT source, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n_tokens FROM t GROUP BY 1) SELECT *, round(n_docs * 100.0 / sum(n_docs) OVER (), 6) AS docs_pct, round(n_tokens * 100.0 / sum(n_tokens) OVER (), 6) AS tokens_pct FROM s",
    "domain_rollup": "WITH r AS (SELECT lower(trim(domain)) AS domain, try_cast(regexp_replace(tokens, '[.,]', '', 'g') AS BIGINT) AS tokens, size_mb FROM resources) SELECT domain, count(*) AS n_resources, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(size_mb), 4) AS size, round(sum(tokens) / 1e6, 4) AS tokens_millions, round(sum(tokens) / 1e9, 4) AS tokens_billions FROM r GROUP BY 1",
    "registry_upsert": "SELECT dataset, reg_date, tokens FROM resources WHERE reg_date LIKE '%/%' AND dataset NOT IN (SELECT dataset FROM resources WHERE reg_date NOT LIKE '%/%') UNION ALL SELECT dataset, reg_date, tokens FROM resources WHERE reg_date NOT LIKE '%/%'",
    "divisor_values": "SELECT DISTINCT lang AS value FROM documents WHERE trim(lang) <> ''",
    "tokens_by_value": f"WITH {_T}, s AS (SELECT lang AS value, count(*) AS n_rows, CAST(sum(tokens) AS BIGINT) AS tokens FROM t WHERE lang IS NOT NULL GROUP BY 1) SELECT *, round(avg(tokens) OVER (), 6) AS mean_tokens, round(stddev_pop(tokens) OVER (), 6) AS stddev_tokens FROM s",
    "number_distribution": "SELECT l_returnflag, count(*) AS n, round(min(l_extendedprice), 6) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(median(l_extendedprice), 6) AS median, round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.75), 6) AS p75, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(max(l_extendedprice), 6) AS max FROM lineitem GROUP BY 1",
    "length_distribution": f"WITH {_T}, x AS (SELECT CAST(tokens AS DOUBLE) AS v FROM t) SELECT count(*) AS n, min(v) AS min, quantile_cont(v, 0.25) AS p25, median(v) AS median, round(avg(v), 6) AS mean, quantile_cont(v, 0.75) AS p75, round(quantile_cont(v, 0.95), 6) AS p95, max(v) AS max FROM x",
    "reject_summary": f"WITH {_COMMENT}, o AS (SELECT coalesce(source, 'null') AS file, unnest(rs) AS reason FROM r) SELECT file, reason, count(*) AS n FROM o GROUP BY 1, 2 UNION ALL SELECT 'ALL', reason, count(*) FROM o GROUP BY 2",
    "kept_summary": f"""WITH {_COMMENT}, o AS (SELECT coalesce(source, 'null') AS file, CAST(len(rs) > 0 AS BIGINT) AS gone FROM r), s AS (SELECT file, count(*) AS n_rows, sum(gone) AS g FROM o GROUP BY 1 UNION ALL SELECT 'ALL', count(*), sum(gone) FROM o)
      SELECT file, n_rows, CAST(n_rows - g AS BIGINT) AS n_kept, CAST(g AS BIGINT) AS n_removed, round(100.0 * (n_rows - g) / n_rows, 6) AS kept_pct FROM s""",
    "metric_summary": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count(v) AS n, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std FROM (SELECT {v} AS v FROM lineitem)"
        for m, v in (("l_quantity", "l_quantity"), ("l_discount", "l_discount"), ("l_tax", "CASE WHEN l_tax > 0.02 THEN l_tax END"))
    ),
    "model_wins": "WITH s AS (SELECT lower(trim(metadata.model_chosen)) AS model, count(*) AS n_wins FROM preferences WHERE metadata.model_chosen IS NOT NULL GROUP BY 1) SELECT *, round(n_wins * 100.0 / sum(n_wins) OVER (), 6) AS pct FROM s",
    "category_distribution": "WITH s AS (SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1) SELECT *, round(n / sum(n) OVER (), 6) AS share FROM s",
    "cluster_dominance": "WITH s AS (SELECT coalesce(lang, 'none') AS cluster, count(*) AS n FROM documents GROUP BY 1), x AS (SELECT *, round(n / sum(n) OVER (), 6) AS share FROM s) SELECT *, share > 0.4 AS dominates FROM x",
    "system_scores": "SELECT event_type, round(coalesce(avg(value), 0.0), 6) AS system_score, count(value) AS n_segments FROM events GROUP BY 1",
    "big_groups": "SELECT doc_id, source FROM documents QUALIFY count(*) OVER (PARTITION BY source) >= 20",
    "group_values": "SELECT DISTINCT source_id FROM corpus_rows",
    "running_ids": "SELECT doc_id, 'web_' || row_number() OVER (ORDER BY doc_id) AS id FROM documents",
    "cleaned_changes": f"SELECT count(*) FILTER ({clean_sql('text')} <> text) AS n_changed, count(*) AS n_rows FROM documents",
}

QUERIES = {
    f.__name__: f
    for f in (
        sample_tokens_stratified, sample_tokens_equal, sample_tokens_per_source, sample_docs_stratified, sample_docs_equal, sample_docs_per_source, sample_category_tokens, sample_category_rows,
        sample_category_specific_tokens, sample_category_specific_rows, balanced_eval_sample, running_tokens, shuffled_order, split_fixed, split_ratio, split_contiguous, split_by_group, annotation_blocks,
        topic_quota_sample, topic_sample_trimmed, topic_sample_filled, jsonl_roundtrip, csv_roundtrip, parts_roundtrip, uniform_sample, random_styles, all_styles, exact_dedup_keep_first, duplicate_id_report, duplicate_groups, keyed_dedup, text_then_id_dedup, duplicate_counters,
        fingerprint_report, best_annotation, merge_existing_wins, resume_anti_join, append_unique_rows, widened_union, minhash_dedup, minhash_short, map_source_ids, enrich_metadata_json, two_key_join,
        counts_attached, answers_of_both, retrieval_join, random_distractors, stats_grouping_sets, corpus_summary, domain_rollup, registry_upsert, divisor_values, tokens_by_value, number_distribution,
        length_distribution, reject_summary, kept_summary, metric_summary, model_wins, category_distribution, cluster_dominance, system_scores, big_groups, group_values, running_ids, cleaned_changes,
    )
}
