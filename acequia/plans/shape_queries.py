"""Queries of projections, small filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from acequia.functions import jsontext
from acequia.functions.text import squeeze, token_count
from acequia.operators import aggregates, dedup, filters, joins, projection, tfidf, vectors
from acequia.operators.quality import STOP_WORDS
from acequia.plans.text_queries import docs, read, tokens_sql
from acequia.plans.text_queries import _WORDS as WORDS_SQL


def elected_text(spark, d):
    rows = docs(spark, d).selectExpr("doc_id as Identificador", "title as txt", "text as contenido", "text as Text2")
    return projection.lower_names(projection.elect_text(projection.rename_id(rows))).select("id", F.md5("text").alias("text_md5"))


def renamed_columns(spark, d):
    mapping = spark.createDataFrame([("source", "dataset"), ("missing", "other")], "original_column_name string, mapped_column_name string")
    return projection.rename_by(docs(spark, d).select("doc_id", "source"), mapping)


def coalesced_ids(spark, d):
    rows = read(spark, d, "parallel_biomedical").select("pair_id", "id", F.col("source_id").alias("other"))
    return projection.coalesced(rows, "key", ["absent", "id", "other"]).select("pair_id", "key")


def list_defaults(spark, d):
    rows = docs(spark, d).select("doc_id", F.when(F.col("lang").isNotNull(), F.array("lang", "source")).alias("tags"))
    return rows.select("doc_id", F.size(projection.empty_if_null(F.col("tags"))).alias("n_tags"), projection.first_or_null(F.col("tags")).alias("first_tag"))


def public_rows(spark, d):
    rows = read(spark, d, "preferences").select("sample_id", "metadata", F.lit("p.jsonl").alias("_source_file"), F.col("sample_id").alias("_source_line"))
    out = projection.public_columns(rows)
    return out.select("sample_id", "metadata.model_chosen", "metadata.source_file", "metadata.source_line")


def unified_schema(spark, d):
    known = [{"query": "query", "passage": "passage"}, {"query": "question", "passage": "passage"}]
    return projection.unify(read(spark, d, "eval_items"), known)


def sample_fitness(spark, d):
    return docs(spark, d).select("doc_id", filters.fit_for_sample(F.col("text"), F.col("title"), 50, 1000, 5, 10).alias("fit"))


def chunk_filters(spark, d):
    t = F.coalesce("text", F.lit(""))
    return docs(spark, d).select("doc_id", filters.dotted_chunk(t, 0.01).alias("few_stops"), filters.within_tokens(token_count(t), 50, 200).alias("within"))


def dated_titles(spark, d):
    return filters.title_and_date(docs(spark, d), "title", "doc_date", ["EXP", "AS-"], "2024-01-01", "2024-12-31", 100, ["doc_id"]).select("doc_id")


def short_titles(spark, d):
    return docs(spark, d).where((F.length("title") < 80) & (F.col("lang").isNull() | (F.col("lang") == ""))).select("doc_id")


def listed_sources(spark, d):
    return docs(spark, d).where(~F.coalesce(F.col("source").isin("Pliegos_Menores", "Boletin_Sierra_Norte"), F.lit(False))).select("doc_id", "source")


def missing_by_field(spark, d):
    return read(spark, d, "eval_items").select("item_id", F.array_join(jsontext.missing_fields(asker=F.col("asker"), difficulty=F.col("difficulty"), answer=F.col("answer")), ",").alias("missing"))


def cache_keys(spark, d):
    return read(spark, d, "eval_items").select("item_id", jsontext.canonical_key(F.col("item_id"), F.col("answer")).alias("key"))


def set_difference(spark, d):
    a, b = docs(spark, d).select(F.lower(F.trim("source")).alias("s")), read(spark, d, "corpus_rows").select(F.lower(F.trim("source_id")).alias("s"))
    return a.distinct().exceptAll(b.distinct())


def set_intersection(spark, d):
    a, b = docs(spark, d).select(F.lower(F.trim("source")).alias("s")), read(spark, d, "corpus_rows").select(F.lower(F.trim("source_id")).alias("s"))
    return a.intersect(b)


def question_dedup(spark, d):
    rows = read(spark, d, "preferences").where("prompt is not null").select("sample_id", "prompt")
    return dedup.keep_first(rows, [F.md5(F.lower(squeeze(F.col("prompt"))))], ["sample_id"]).select("sample_id")


def last_per_key(spark, d):
    return dedup.keep_last_window(read(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], ["event_id"])


def category_counts(spark, d):
    rows = docs(spark, d).select(F.split(F.coalesce("title", F.lit("")), ", ").alias("parts"))
    return aggregates.distribution_of(rows, "parts").select("value", "n")


def matched_questions(spark, d):
    items = read(spark, d, "eval_items")
    left = items.select("item_id", F.lower(squeeze(F.col("question"))).alias("q")).where("q <> ''")
    right = items.groupBy(F.lower(squeeze(F.col("question"))).alias("q2")).agg(F.count("answer").alias("n_answers"))
    return joins.two_key(left, right, [("q", "q2")]).select("item_id", "n_answers")


def weight_sums(spark, d):
    counted = tfidf.terms(docs(spark, d), "doc_id", "text", STOP_WORDS)
    return counted.groupBy("id").agg(F.sum("n").alias("n_words"), F.count("*").alias("n_terms"))


def unit_index(spark, d):
    rows = vectors.index(read(spark, d, "embeddings"))
    return rows.select("id", F.size("vector").alias("size"), F.round(F.col("vector")[0], 6).alias("first"))


ORACLES = {
    "elected_text": "SELECT doc_id AS id, md5(text) AS text_md5 FROM documents",
    "renamed_columns": "SELECT doc_id, source AS dataset FROM documents",
    "coalesced_ids": "SELECT pair_id, coalesce(id, source_id) AS key FROM parallel_biomedical",
    "list_defaults": "SELECT doc_id, CASE WHEN lang IS NULL THEN 0 ELSE 2 END AS n_tags, lang AS first_tag FROM documents",
    "public_rows": "SELECT sample_id, metadata.model_chosen AS model_chosen, 'p.jsonl' AS source_file, sample_id AS source_line FROM preferences",
    "unified_schema": "SELECT question AS query, passage FROM eval_items",
    "sample_fitness": r"""SELECT doc_id, length(text) BETWEEN 50 AND 1000 AND len(list_filter(string_split_regex(trim(text, ' '), '\s+'), lambda w: w <> '')) >= 5 AND NOT regexp_matches(text, 'https?://\S+')
        AND length(trim(regexp_replace(coalesce(title, ''), 'https?://\S+', '', 'g'), ' ')) >= 10 AS fit FROM documents""",
    "chunk_filters": f"""SELECT doc_id, CASE WHEN length(text) > 0 THEN (length(text) - length(replace(text, '.', ''))) / length(text) ELSE 0.0 END < 0.01 AS few_stops, {tokens_sql('text')} BETWEEN 50 AND 328 AS within FROM documents""",
    "short_titles": "SELECT doc_id FROM documents WHERE length(title) < 80 AND (lang IS NULL OR lang = '')",
    "listed_sources": "SELECT doc_id, source FROM documents WHERE source IS NULL OR source NOT IN ('Pliegos_Menores', 'Boletin_Sierra_Norte')",
    "missing_by_field": "SELECT item_id, concat_ws(',', CASE WHEN asker IS NULL OR trim(asker) = '' THEN 'asker' END, CASE WHEN difficulty IS NULL OR trim(difficulty) = '' THEN 'difficulty' END, CASE WHEN answer IS NULL OR trim(answer) = '' THEN 'answer' END) AS missing FROM eval_items",
    "cache_keys": "SELECT item_id, sha256(CAST(to_json({item_id: item_id, answer: answer}) AS VARCHAR)) AS key FROM eval_items",
    "set_difference": "SELECT DISTINCT lower(trim(source)) AS s FROM documents EXCEPT SELECT lower(trim(source_id)) FROM corpus_rows",
    "set_intersection": "SELECT DISTINCT lower(trim(source)) AS s FROM documents INTERSECT SELECT lower(trim(source_id)) FROM corpus_rows",
    "question_dedup": r"SELECT min(sample_id) AS sample_id FROM preferences WHERE prompt IS NOT NULL GROUP BY lower(trim(regexp_replace(prompt, '[\s\x0b\x85\p{Z}]+', ' ', 'g'), ' '))",
    "last_per_key": "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
    "category_counts": "SELECT value, count(*) AS n FROM (SELECT unnest(string_split(coalesce(title, ''), ', ')) AS value FROM documents) GROUP BY 1",
    "matched_questions": r"""WITH q AS (SELECT item_id, answer, lower(trim(regexp_replace(coalesce(question, ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g'), ' ')) AS q FROM eval_items), a AS (SELECT q, count(answer) AS n_answers FROM q GROUP BY 1)
      SELECT item_id, n_answers FROM q LEFT JOIN a USING (q) WHERE q <> ''""",
    "weight_sums": f"WITH w AS (SELECT doc_id AS id, term, count(*) AS n FROM (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents) WHERE term NOT IN ({', '.join(repr(w) for w in STOP_WORDS)}) GROUP BY 1, 2) SELECT id, CAST(sum(n) AS BIGINT) AS n_words, count(*) AS n_terms FROM w GROUP BY 1",
    "unit_index": "SELECT vec_id AS id, 64 AS size, round(CAST(embedding[1] AS DOUBLE) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS first FROM embeddings",
}

QUERIES = {
    f.__name__: f
    for f in (
        elected_text, renamed_columns, coalesced_ids, list_defaults, public_rows, unified_schema, sample_fitness, chunk_filters, dated_titles, short_titles, listed_sources, missing_by_field, cache_keys,
        set_difference, set_intersection, question_dedup, last_per_key, category_counts, matched_questions, weight_sums, unit_index,
    )
}
