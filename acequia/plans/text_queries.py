"""Queries of text functions, filters and quality rules over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.functions import dates, jsontext
from acequia.functions import text as X
from acequia.operators import aggregates, chunking, dedup, filters, projection, quality, tfidf
from acequia.session import spread
from acequia.sources.html import html_to_text


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their tokens."""
    return docs(spark, sf_dir).withColumn("tokens", X.token_count(F.col("text")))


def joined(reasons: str = "reasons"):
    return F.array_join(reasons, ",").alias("reasons")


TOKENS = r"CAST(coalesce(len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\p{{Z}}\x{{85}}]')), 0) AS BIGINT)"


def tokens_sql(column: str) -> str:
    return TOKENS.format(column)


STEP_SQL = {
    "hashes": "replace({0}, '#', '')",
    "images": r"regexp_replace({0}, '!\[.*?\]\(.*?\)', '', 'g')",
    "newlines": r"regexp_replace({0}, '[\r\n]{{2,}}', chr(10), 'g')",
    "headings": r"regexp_replace({0}, '(?m)^\s*=+\s*(.+?)\s*=+\s*$', '\1:', 'g')",
    "open_lines": r"""regexp_replace({0}, '([^\s\.,;:!?\)\]\}}\"''»”])\r?\n\s*([A-ZÁÉÍÓÚÜÑ])', '\1.' || chr(10) || '\2', 'g')""",
}


def clean_sql(column: str) -> str:
    for step in STEP_SQL.values():
        column = step.format(column)
    return column


def source_token_stats(spark, d):
    once = dedup.text_dedup(docs(spark, d).select("doc_id", "source", X.clean(F.col("text")).alias("text")))
    return aggregates.source_stats(once.withColumn("tokens", X.token_count(F.col("text"))))


def clean_text_chain(spark, d):
    c = X.clean(F.col("text"))
    return docs(spark, d).select("doc_id", F.md5(c).alias("clean_md5"), (c != F.col("text")).alias("changed"))


def clean_single_steps(spark, d):
    return docs(spark, d).select("doc_id", *[F.md5(step(F.col("text"))).alias(f"{name}_md5") for name, step in X.CLEANING.items()])


def token_counts(spark, d):
    return counted(spark, d).select("doc_id", "tokens")


def text_normalisers(spark, d):
    t = F.col("text")
    made = {"squeezed": X.squeeze(t), "reflowed": X.reflow(t), "keyed": X.match_key(t), "unreferenced": X.drop_references(t), "cut": X.within_budget(t, 100), "by_pattern": X.html_by_pattern(t), "repaired": X.repair_encoding(t)}
    return docs(spark, d).where(t.isNotNull()).select("doc_id", *[F.md5(c).alias(n) for n, c in made.items()])


def mask_personal(spark, d):
    return docs(spark, d).select("doc_id", F.md5(X.mask_mentions(X.mask_personal(F.col("text")))).alias("masked_md5"))


def symbol_lines(spark, d):
    return docs(spark, d).select("doc_id", F.md5(X.drop_symbol_lines(F.col("text"), "-")).alias("kept_md5"))


def spam_filter_reasons(spark, d):
    return docs(spark, d).select("doc_id", X.url_count(F.col("text")).alias("n_urls"), X.mention_count(F.col("text")).alias("n_mentions"), F.round(X.symbol_share(F.col("text")), 6).alias("symbol_share"), F.array_join(filters.spam_reasons(F.col("text"), with_runs=False), ",").alias("reasons"))


def character_runs(spark, d):
    return docs(spark, d).where(X.has_run(F.col("text"), 10)).select("doc_id")


def text_kinds(spark, d):
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs(spark, d).select("doc_id", X.just_url(t).alias("just_url"), t.rlike(X.LETTER).alias("has_letter"), X.ends_truncated(t).alias("truncated"))


def emoji_only(spark, d):
    return docs(spark, d).where(X.only_emoji(F.col("text"))).select("doc_id")


def comment_filters(spark, d):
    reasons = filters.comment_reasons(F.col("text"), F.col("title"), F.col("url"))
    return docs(spark, d).select("doc_id", F.array_join(reasons, ",").alias("reasons"))


def quality_web(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", F.array_join(quality.web_reasons(F.col("text")), ",").alias("reasons"))


def quality_document(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", F.array_join(quality.document_reasons(F.col("text")), ",").alias("reasons"))


def quality_repetition(spark, d):
    return spread(docs(spark, d).where("text is not null").select("doc_id", "text")).select("doc_id", F.array_join(quality.repetition_reasons(F.col("text")), ",").alias("reasons"))


def quality_lines(spark, d):
    stats = quality.line_stats(F.col("text"))
    return docs(spark, d).where("text is not null").select("doc_id", *[F.round(c, 6).alias(n) for n, c in stats.items()])


def language_scores(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", F.round(filters.language_score(F.col("text"), quality.STOP_WORDS), 6).alias("score"))


def fixed_chunks(spark, d):
    return chunking.fixed_chunks(docs(spark, d), "doc_id", "text", 500).select("id", "chunk_no", F.md5("chunk").alias("chunk_md5"))


def sentence_context(spark, d):
    return chunking.sentence_context(docs(spark, d), "doc_id", "text")


def semantic_chunks(spark, d):
    return chunking.semantic_chunks(spread(docs(spark, d).select("source", "doc_id", "text")), "source", "doc_id", "text")


def semantic_chunk_stats(spark, d):
    return aggregates.chunk_stats(semantic_chunks(spark, d), "chunk", "tokens", "valid", "id_document")


def html_visible_text(spark, d):
    return docs(spark, d).select("doc_id", F.md5(html_to_text("text")).alias("text_md5"))


def document_dates(spark, d):
    return docs(spark, d).select("doc_id", dates.parse_date(F.col("doc_date")).alias("day"))


def month_windows(spark, d):
    span = read(spark, d, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    return span.select(F.posexplode(dates.month_windows(F.col("a"), F.col("b"))).alias("n", "w")).select("n", F.col("w.from").alias("from_day"), F.col("w.to").alias("to_day"))


def event_properties(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), jsontext.flag(F.get_json_object("props", "$.k")).alias("flag"))


def json_repair(spark, d):
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return read(spark, d, "events").select("event_id", jsontext.repaired(cut).alias("repaired"))


def text_hashes(spark, d):
    return docs(spark, d).select("doc_id", X.hash_parts(F.coalesce("source", F.lit("")), F.coalesce("text", F.lit(""))).alias("h"))


def word_five_grams(spark, d):
    grams = F.explode(X.word_grams(F.col("text"), 5))
    return docs(spark, d).where("text is not null").select("doc_id", grams.alias("gram")).groupBy("doc_id").agg(F.count("*").alias("n_grams"), F.countDistinct("gram").alias("n_distinct"))


def tfidf_vocab(spark, d):
    return tfidf.vocabulary(tfidf.terms(docs(spark, d), "doc_id", "text", quality.STOP_WORDS), 5, 500)


def tfidf_vectors(spark, d):
    counted_ = tfidf.terms(docs(spark, d), "doc_id", "text", quality.STOP_WORDS)
    return tfidf.vectors(counted_, tfidf.vocabulary(counted_, 5, 500), docs(spark, d).count())


def top_terms(spark, d):
    counted_ = tfidf.terms(docs(spark, d), "doc_id", "text", quality.STOP_WORDS)
    weights = tfidf.vectors(counted_, tfidf.vocabulary(counted_, 5, 500), docs(spark, d).count())
    return tfidf.top_terms(weights, docs(spark, d).select(F.col("doc_id").alias("id"), F.coalesce(F.lower("lang"), F.lit("none")).alias("cluster")), 10)


def reasoning_prefixes(spark, d):
    return filters.reasoning_counts(read(spark, d, "preferences"))


def row_completeness(spark, d):
    rows = read(spark, d, "parallel_biomedical")
    return filters.not_blank(filters.complete(rows, ["text_es", "text_en", "id"]), ["text_es", "text_en"]).select("pair_id")


def prompt_validity(spark, d):
    return read(spark, d, "responses").select("prompt_id", "model", filters.prompt_valid(F.col("response"), 20, 400).alias("valid")).distinct()


def core_columns(spark, d):
    return projection.core(docs(spark, d), "web", "doc_id").select("source_id", "id", F.md5("text").alias("text_md5"))


_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
_WORDS = r"regexp_extract_all(lower(text), '\p{L}{3,}')"
_LINES = r"list_filter(string_split_regex(text, '\r\n|\n|\r'), lambda x: trim(x, ' ') <> '')"
_CHARS = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"
_SPACE = r"string_split_regex(text, '\s+')"
_TERMS = f"""
  w AS (SELECT doc_id AS id, term, count(*) AS n FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM documents) WHERE term NOT IN ({_STOP}) GROUP BY 1, 2),
  v AS (SELECT term, count(*) AS df, CAST(sum(n) AS BIGINT) AS tf FROM w GROUP BY 1 HAVING count(*) >= 5 ORDER BY tf DESC, df DESC, term DESC LIMIT 500)"""
_WEIGHTS = f"""{_TERMS},
  s AS (SELECT id, sum(n) AS size FROM w GROUP BY 1),
  r AS (SELECT w.id, w.term, w.n / s.size * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + v.df)) + 1) AS w FROM w JOIN v USING (term) JOIN s USING (id)),
  l AS (SELECT id, sqrt(sum(w * w)) AS l FROM r GROUP BY 1),
  x AS (SELECT r.id, r.term, round(r.w / l.l, 6) AS weight FROM r JOIN l USING (id))"""
_MOJIBAKE = "text"
for _wrong, _right in X.MOJIBAKE.items():
    _MOJIBAKE = f"replace({_MOJIBAKE}, '{_wrong}', '{_right}')"

ORACLES = {
    "source_token_stats": f"""
      WITH c AS (SELECT doc_id, source, {clean_sql('text')} AS text FROM documents),
        o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
        s AS (SELECT source, count(*) AS n_docs, CAST(sum({tokens_sql('text')}) AS BIGINT) AS n_tokens FROM o GROUP BY 1)
      SELECT source, n_docs, n_tokens, round(n_docs * 100.0 / sum(n_docs) OVER (), 6) AS docs_pct, round(n_tokens * 100.0 / sum(n_tokens) OVER (), 6) AS tokens_pct FROM s""",
    "clean_text_chain": f"SELECT doc_id, md5({clean_sql('text')}) AS clean_md5, {clean_sql('text')} <> text AS changed FROM documents",
    "clean_single_steps": "SELECT doc_id, " + ", ".join(f"md5({s.format('text')}) AS {n}_md5" for n, s in STEP_SQL.items()) + " FROM documents",
    "token_counts": f"SELECT doc_id, {tokens_sql('text')} AS tokens FROM documents",
    "text_normalisers": rf"""SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x0b\x85\p{{Z}}]+', ' ', 'g'), ' ')) AS squeezed,
        md5(replace(replace(replace(text, '.' || chr(10), '.' || chr(9)), chr(10), ' '), chr(9), chr(10))) AS reflowed,
        md5(regexp_replace(lower(text), '[^a-z0-9áéíóúüñ]', '', 'g')) AS keyed, md5(regexp_replace(text, '\[\d+\]', '', 'g')) AS unreferenced, md5(substring(text, 1, 370)) AS cut,
        md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\r\n\t]+', ' ', 'g'), ' +', ' ', 'g'), ' ')) AS by_pattern, md5({_MOJIBAKE}) AS repaired
      FROM documents WHERE text IS NOT NULL""",
    "mask_personal": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g'),
        '\b(?:\d{1,3}\.){3}\d{1,3}\b', '<IP>', 'g'), '@[\p{L}\p{N}_\.-]+', '@usuario', 'g')) AS masked_md5 FROM documents""",
    "symbol_lines": "SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (contains(x, '-') AND trim(replace(x, '-', ''), ' ') = '')), chr(10))) AS kept_md5 FROM documents",
    "spam_filter_reasons": r"""
      WITH c AS (SELECT doc_id, text, CAST(coalesce(len(regexp_extract_all(text, 'https?://\S+|www\.\S+')), 0) AS INTEGER) AS n_urls,
          CAST(coalesce(len(regexp_extract_all(text, '@[\p{L}\p{N}_]+')), 0) AS INTEGER) AS n_mentions,
          CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '[^\p{L}\s]')) / length(text) ELSE 0.0 END AS share FROM documents)
      SELECT doc_id, n_urls, n_mentions, round(share, 6) AS symbol_share,
        concat_ws(',', CASE WHEN n_urls > 1 THEN 'urls' END, CASE WHEN n_mentions > 3 THEN 'mentions' END, CASE WHEN share > 0.6 THEN 'symbols' END) AS reasons FROM c""",
    "text_kinds": r"""SELECT doc_id, length(trim(regexp_replace(coalesce(text, ''), 'https?://\S+|www\.\S+', '', 'g'), ' ')) < 30 AS just_url,
        regexp_matches(coalesce(text, ''), '[a-záéíóúüñA-ZÁÉÍÓÚÜÑ]') AS has_letter,
        ends_with(coalesce(text, ''), '[truncated]') OR ends_with(coalesce(text, ''), '<|im_end|') OR ends_with(coalesce(text, ''), '<|endoftext|') AS truncated FROM documents""",
    "comment_filters": r"""SELECT doc_id, concat_ws(',', CASE WHEN text IS NULL THEN 'no_text' END, CASE WHEN NOT regexp_matches(text, '[a-záéíóúüñA-ZÁÉÍÓÚÜÑ]') THEN 'no_letter' END,
        CASE WHEN length(trim(regexp_replace(text, 'https?://\S+|www\.\S+', '', 'g'), ' ')) < 30 THEN 'just_url' END, CASE WHEN regexp_matches(text, '(?i)bienvenido') THEN 'welcome' END,
        CASE WHEN regexp_matches(text, '(?i)(listado.*no.repetidas|no.repetidas.*listado|propuestas.*no.repetidas)') THEN 'listing' END,
        CASE WHEN regexp_matches(title, '(?i)#T[uú]Preguntas') THEN 'questions' END, CASE WHEN length(coalesce(url, '')) = 0 THEN 'no_description' END) AS reasons FROM documents""",
    "quality_lines": rf"""
      WITH l AS (SELECT doc_id, text, {_LINES} AS ls FROM documents WHERE text IS NOT NULL), u AS (SELECT *, list_distinct(ls) AS us, len(ls) AS n FROM l)
      SELECT doc_id, round(CASE WHEN n > 0 THEN (n - len(us)) / n ELSE 0.0 END, 6) AS repeated_lines,
        round(CASE WHEN n > 0 THEN len(list_filter(ls, lambda x: regexp_matches(rtrim(x, ' '), '[.!?…]$'))) / n ELSE 0.0 END, 6) AS punctuated_lines,
        round(CASE WHEN n > 0 THEN len(list_filter(ls, lambda x: length(x) <= 30)) / n ELSE 0.0 END, 6) AS short_lines,
        round(CASE WHEN length(text) > 0 THEN ({_CHARS.format('ls')} - {_CHARS.format('us')}) / length(text) ELSE 0.0 END, 6) AS repeated_chars,
        round(CASE WHEN len(regexp_extract_all(text, '\S+')) > 0 THEN len(regexp_extract_all(text, '\n')) / len(regexp_extract_all(text, '\S+')) ELSE 0.0 END, 6) AS breaks_per_word FROM u""",
    "quality_web": rf"""
      WITH l AS (SELECT doc_id, text, {_LINES} AS ls FROM documents WHERE text IS NOT NULL), u AS (SELECT *, list_distinct(ls) AS us, len(ls) AS n FROM l),
        s AS (SELECT doc_id, CASE WHEN n > 0 THEN len(list_filter(ls, lambda x: regexp_matches(rtrim(x, ' '), '[.!?…]$'))) / n ELSE 0.0 END AS p,
        CASE WHEN n > 0 THEN len(list_filter(ls, lambda x: length(x) <= 30)) / n ELSE 0.0 END AS s,
        CASE WHEN length(text) > 0 THEN ({_CHARS.format('ls')} - {_CHARS.format('us')}) / length(text) ELSE 0.0 END AS r,
        CASE WHEN len(regexp_extract_all(text, '\S+')) > 0 THEN len(regexp_extract_all(text, '\n')) / len(regexp_extract_all(text, '\S+')) ELSE 0.0 END AS b FROM u)
      SELECT doc_id, concat_ws(',', CASE WHEN p <= 0.1 THEN 'line_punctuation' END, CASE WHEN s > 0.67 THEN 'short_lines' END, CASE WHEN r > 0.35 THEN 'repeated_characters' END, CASE WHEN b > 1.0 THEN 'line_breaks' END) AS reasons FROM s""",
    "quality_document": rf"""
      WITH w AS (SELECT doc_id, text, list_filter({_SPACE}, lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
        s AS (SELECT doc_id, len(ws) AS n, CASE WHEN len(ws) > 0 THEN {_CHARS.format('ws')} / len(ws) ELSE 0.0 END AS m,
        CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) / len(ws) ELSE 0.0 END AS a,
        len(list_distinct(list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda x: x IN ({_STOP})))) AS k FROM w)
      SELECT doc_id, concat_ws(',', CASE WHEN n > 1000000 THEN 'word_count' END, CASE WHEN NOT m BETWEEN 2 AND 16 THEN 'word_length' END, CASE WHEN a < 0.3 THEN 'alphabetic_words' END, CASE WHEN k < 2 THEN 'stop_words' END) AS reasons FROM s""",
    "language_scores": rf"""SELECT doc_id, round(CASE WHEN len(regexp_extract_all(text, '\p{{L}}+')) > 0 THEN len(list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda x: x IN ({_STOP}))) / len(regexp_extract_all(lower(text), '\p{{L}}+')) ELSE 0.0 END, 6) AS score FROM documents WHERE text IS NOT NULL""",
    "fixed_chunks": "SELECT doc_id AS id, CAST(k AS INTEGER) AS chunk_no, md5(substring(text, CAST(k * 500 + 1 AS BIGINT), 500)) AS chunk_md5 FROM (SELECT doc_id, text, unnest(range(CAST(ceil(length(text) / 500) AS BIGINT))) AS k FROM documents WHERE length(text) > 0)",
    "document_dates": r"""SELECT doc_id, CAST(CASE WHEN regexp_matches(replace(trim(doc_date), '/', '-'), '^\d{1,2}-\d{1,2}-\d{4}$') THEN try_strptime(replace(trim(doc_date), '/', '-'), '%d-%m-%Y')
        WHEN regexp_matches(trim(doc_date), '^\d{4}$') THEN try_strptime(trim(doc_date) || '-01-01', '%Y-%m-%d')
        WHEN regexp_matches(replace(trim(doc_date), '/', '-'), '^\d{4}-\d{2}-\d{2}$') THEN try_strptime(replace(trim(doc_date), '/', '-'), '%Y-%m-%d') END AS DATE) AS day FROM documents""",
    "month_windows": """
      WITH s AS (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM events), g AS (SELECT CAST(unnest(generate_series(a, b - 1, INTERVAL 1 MONTH)) AS DATE) AS f, b FROM s)
      SELECT CAST(row_number() OVER (ORDER BY f DESC) - 1 AS INTEGER) AS n, f AS from_day, CAST(least(f + INTERVAL 1 MONTH, b) AS DATE) AS to_day FROM g""",
    "event_properties": "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, CASE props ->> '$.k' WHEN '1' THEN 1 WHEN '0' THEN 0 END AS flag FROM events",
    "text_hashes": "SELECT doc_id, sha256(coalesce(source, '') || '␟' || coalesce(text, '')) AS h FROM documents",
    "word_five_grams": r"""
      WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, array_to_string(ws[k : k + 4], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS k FROM w))
      SELECT doc_id, count(*) AS n_grams, count(DISTINCT gram) AS n_distinct FROM g GROUP BY 1""",
    "tfidf_vocab": f"WITH {_TERMS} SELECT term, df, tf FROM v",
    "tfidf_vectors": f"WITH {_WEIGHTS} SELECT id, term, weight FROM x",
    "top_terms": f"""WITH {_WEIGHTS}, c AS (SELECT coalesce(lower(lang), 'none') AS cluster, term, round(sum(weight), 6) AS weight FROM x JOIN documents ON doc_id = id GROUP BY 1, 2)
      SELECT cluster, term, weight, CAST(row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS INTEGER) AS rank FROM c QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) <= 10""",
    "reasoning_prefixes": r"""
      WITH s AS (SELECT coalesce(regexp_matches(chosen, '(?i)^\s*<think') OR regexp_matches(chosen, '(?i)^\s*(?:okay|ok|alright|let me|hmm|vale|veamos|bueno),?\b'), false) AS a,
        coalesce(regexp_matches(rejected, '(?i)^\s*<think') OR regexp_matches(rejected, '(?i)^\s*(?:okay|ok|alright|let me|hmm|vale|veamos|bueno),?\b'), false) AS b FROM preferences)
      SELECT count(*) AS n_rows, count(*) FILTER (a) AS in_chosen, count(*) FILTER (b) AS in_rejected, count(*) FILTER (a AND b) AS in_both, count(*) FILTER (a OR b) AS in_any FROM s""",
    "row_completeness": "SELECT pair_id FROM parallel_biomedical WHERE id IS NOT NULL AND trim(text_es, ' ') <> '' AND trim(text_en, ' ') <> ''",
    "core_columns": "SELECT 'web' AS source_id, CAST(doc_id AS VARCHAR) AS id, md5(text) AS text_md5 FROM documents",
}

QUERIES = {
    f.__name__: f
    for f in (
        source_token_stats, clean_text_chain, clean_single_steps, token_counts, text_normalisers, mask_personal, symbol_lines, spam_filter_reasons, character_runs, text_kinds, emoji_only,
        comment_filters, quality_web, quality_document, quality_repetition, quality_lines, language_scores, fixed_chunks, sentence_context, semantic_chunks, semantic_chunk_stats, html_visible_text,
        document_dates, month_windows, event_properties, json_repair, text_hashes, word_five_grams, tfidf_vocab, tfidf_vectors, top_terms, reasoning_prefixes, row_completeness, prompt_validity, core_columns,
    )
}
