"""SQL of the n-gram scores and of sentences with their neighbours."""

from __future__ import annotations

from acequia.plans.model_queries import _MEASURED, overlap_scores

_SPACE = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]+"
_TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\p{{Z}}\x{{85}}]')"


def _scores(rows: str) -> str:
    """CTEs up to sc (sample_id, chrf, bleu) of ``rows``, a query of (sample_id, a, b)."""
    return rf"""
  w AS ({rows}),
  t AS (SELECT sample_id, {_TOKENS.format('a')} AS a, {_TOKENS.format('b')} AS b FROM w),
  o AS (SELECT unnest(range(1, 7)) AS n),
  tg AS (SELECT sample_id, n, 1 AS x, 0 AS y, a[i : i + n - 1] AS g FROM (SELECT *, unnest(range(1, len(a) - n + 2)) AS i FROM t, o WHERE n <= 4)
    UNION ALL SELECT sample_id, n, 0, 1, b[i : i + n - 1] FROM (SELECT *, unnest(range(1, len(b) - n + 2)) AS i FROM t, o WHERE n <= 4)),
  tm AS (SELECT sample_id, n, sum(least(x, y)) AS same FROM (SELECT sample_id, n, g, sum(x) AS x, sum(y) AS y FROM tg GROUP BY ALL) GROUP BY 1, 2),
  bl AS (SELECT sample_id, CASE WHEN len(any_value(a)) = 0 OR len(any_value(b)) = 0 THEN CAST(len(any_value(a)) = len(any_value(b)) AS DOUBLE)
      ELSE least(1.0, exp(1 - len(any_value(b)) / len(any_value(a)))) * exp(avg(ln((coalesce(same, 0) + 1) / (greatest(len(a) - n + 1, 0) + 1)))) END AS bleu
    FROM (SELECT * FROM t, o WHERE n <= 4) LEFT JOIN tm USING (sample_id, n) GROUP BY 1),
  c AS (SELECT sample_id, a = '' AND b = '' AS none, trim(regexp_replace(lower(a), '{_SPACE}', ' ', 'g')) AS a, trim(regexp_replace(lower(b), '{_SPACE}', ' ', 'g')) AS b FROM w),
  cg AS (SELECT sample_id, n, 1 AS x, 0 AS y, substr(a, i, n) AS g FROM (SELECT *, unnest(range(1, greatest(length(a) - n + 1, 1) + 1)) AS i FROM c, o WHERE a <> '' AND b <> '')
    UNION ALL SELECT sample_id, n, 0, 1, substr(b, i, n) FROM (SELECT *, unnest(range(1, greatest(length(b) - n + 1, 1) + 1)) AS i FROM c, o WHERE a <> '' AND b <> '')),
  cm AS (SELECT sample_id, n, sum(least(x, y)) AS same FROM (SELECT sample_id, n, g, sum(x) AS x, sum(y) AS y FROM cg GROUP BY ALL) GROUP BY 1, 2),
  pr AS (SELECT sample_id, avg(same / greatest(length(a) - n + 1, 1)) AS p, avg(same / greatest(length(b) - n + 1, 1)) AS r FROM c JOIN cm USING (sample_id) GROUP BY 1),
  sc AS (SELECT c.sample_id, CASE WHEN c.none THEN 1.0 WHEN p IS NULL OR p + r = 0 THEN 0.0 ELSE 5 * p * r / (4 * p + r) END AS chrf, bleu
    FROM c JOIN bl USING (sample_id) LEFT JOIN pr USING (sample_id))"""


_PAIRS = "SELECT sample_id, chosen AS a, rejected AS b FROM preferences WHERE chosen IS NOT NULL AND rejected IS NOT NULL"

ORACLES = {
    "segment_scores": f"WITH {_scores(_PAIRS)} SELECT sample_id, round(chrf, 6) AS chrf, round(bleu, 6) AS bleu FROM sc",
    "preference_reject_measured": f"""WITH {_MEASURED}, {_scores("SELECT sample_id, chosen AS a, rejected AS b FROM r")}
      SELECT sample_id, round(chrf, 6) AS chrf, round(bleu, 6) AS bleu, CASE WHEN prompt = '' OR chosen = '' OR rejected = '' THEN reasons
        ELSE concat_ws(',', nullif(reasons, ''), CASE WHEN chrf > 0.9 THEN 'high_chrf' END, CASE WHEN bleu > 0.9 THEN 'high_bleu' END) END AS reasons FROM r JOIN sc USING (sample_id)""",
    "corpus_bleu": f"""WITH {_scores(_PAIRS)},
      l AS (SELECT CAST(sum(len(a)) AS BIGINT) AS h, CAST(sum(len(b)) AS BIGINT) AS r FROM t),
      q AS (SELECT n, sum(greatest(len(a) - n + 1, 0)) AS total FROM t, o WHERE n <= 4 GROUP BY 1),
      m AS (SELECT n, sum(same) AS same FROM tm GROUP BY 1)
      SELECT round(any_value(CASE WHEN h < r THEN exp(1 - r / h) ELSE 1 END) * exp(sum(ln(same / total)) / 4), 6) AS bleu, any_value(h) AS hypothesis_tokens, any_value(r) AS reference_tokens FROM q JOIN m USING (n), l""",
    "sentence_context": r"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.?!])[\s\x0b]+', '\1' || chr(30), 'g'), chr(30)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL)
      SELECT doc_id AS id, CAST(i - 1 AS INTEGER) AS n, l[i] AS sentence, concat_ws(' ', CASE WHEN i > 1 THEN l[i - 1] END, l[i], l[i + 1]) AS context FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM s)""",
}
ORACLES["sentence_windows"] = f"SELECT id, count(*) AS n, CAST(sum(length(sentence)) AS BIGINT) AS chars, CAST(sum(length(context)) AS BIGINT) AS context_chars FROM ({ORACLES['sentence_context']}) GROUP BY 1"

_NUMBER = "('0x' || substr(md5({0}), 1, 15))::BIGINT"
ORACLES["random_distractors"] = f"""WITH c AS (SELECT DISTINCT id_passage AS p FROM eval_items), n AS (SELECT greatest(1, count(*) // 40) AS b FROM c),
  h AS (SELECT p, {_NUMBER.format("'42|' || p")} % b AS b FROM c, n),
  q AS (SELECT item_id AS q, id_passage AS rel FROM eval_items WHERE question IS NOT NULL),
  r AS (SELECT DISTINCT q, rel, ({_NUMBER.format("'43|' || q")} + i) % b AS b FROM (SELECT q, rel, b, unnest(range(0, least(2, b - 1) + 1)) AS i FROM q, n))
  SELECT q AS item_id, rel AS id_passage, 1 AS label FROM q
  UNION ALL SELECT q, p, 0 FROM (SELECT q, p FROM r JOIN h USING (b) WHERE p <> rel QUALIFY row_number() OVER (PARTITION BY q ORDER BY {_NUMBER.format("'42|' || q || '|' || p")}, p) <= 20)"""
ORACLES["consolidated_tables"] = r"""SELECT nfc_normalize(i) AS id, source, TRY_CAST(nullif(regexp_extract(i, '(\d{4}-\d{2}-\d{2})', 1), '') AS DATE) AS date, CAST(doc_id % 1000 AS VARCHAR) AS number, '14' AS legislature
  FROM (SELECT *, 'ds_' || coalesce(substr(doc_date, 1, 10), 'x') || '_n' || (doc_id % 1000) || '_leg14' AS i FROM documents)"""
ORACLES["rouge_scores"] = f"""WITH {_scores(_PAIRS)},
  l AS (SELECT sample_id, n, greatest(len(a) - n + 1, 0) AS x, greatest(len(b) - n + 1, 0) AS y FROM t, o WHERE n <= 2),
  f AS (SELECT sample_id, n, CASE WHEN x = 0 OR y = 0 THEN CAST(x = y AS DOUBLE) ELSE 2 * coalesce(same, 0) / (x + y) END AS f FROM l LEFT JOIN tm USING (sample_id, n))
  SELECT sample_id, round(max(f) FILTER (n = 1), 6) AS rouge_1, round(max(f) FILTER (n = 2), 6) AS rouge_2 FROM f GROUP BY 1"""
ORACLES["dated_titles"] = r"""SELECT doc_id FROM (SELECT doc_id, regexp_replace(lower(title), '[^a-z0-9áéíóúüñ]', '', 'g') AS k, trim(doc_date) AS d FROM documents)
  WHERE (contains(k, 'exp') OR contains(k, 'as')) AND coalesce(CASE WHEN regexp_matches(d, '^\d{4}-\d{1,2}-\d{1,2}$') THEN TRY_CAST(d AS DATE) WHEN regexp_matches(d, '^\d{4}-\d{1,2}$') THEN TRY_CAST(d || '-01' AS DATE)
    WHEN regexp_matches(d, '^\d{4}$') THEN TRY_CAST(d || '-01-01' AS DATE) END BETWEEN DATE '2024-01-01' AND DATE '2024-12-31', true) ORDER BY doc_id LIMIT 100"""


def rouge_scores(spark, d):
    return overlap_scores(spark, d).select("sample_id", "rouge_1", "rouge_2")


QUERIES = {"rouge_scores": rouge_scores}
