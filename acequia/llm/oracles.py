"""SQL for the queries that SQL can state, over the same tables."""

from __future__ import annotations

_TOKENS = r"coalesce(len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\p{{Z}}\x{{85}}]')), 0)"
_WORDS = r"regexp_extract_all(strip_accents(lower({0})), '[\p{{L}}\p{{N}}]+')"
_NAME = "coalesce(lower(trim({0})), 'unknown')"


def _tokens(column: str) -> str:
    return _TOKENS.format(column)


def _words(column: str) -> str:
    return _WORDS.format(column)


def _overlap(side: str, number: int) -> str:
    """Words in common over words in either, of two rows' word counts."""
    return f"""c{number} AS (
  SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS common
  FROM w{number} a JOIN w{number} b ON a.w = b.w AND {side}
  GROUP BY 1, 2)"""


P2_FOUND = f"""
WITH said AS (
  SELECT {_NAME.format('source_id')} AS source_id, id, loaded_at, {_tokens('text')} AS n,
    CASE WHEN json_valid(metadata) THEN metadata END AS m FROM corpus_rows),
  spelled AS (
  SELECT source_id, id, loaded_at, n, regexp_extract(strip_accents(lower(trim(coalesce(
    nullif(trim(m ->> '$.lang'), ''), nullif(trim(m ->> '$.idioma'), ''), nullif(trim(m ->> '$.language'), ''), '')))), '^[a-z]+') AS l FROM said),
  once AS (
  SELECT source_id, id, arg_max(n, loaded_at) AS n, arg_max(CASE
    WHEN l IN ('es', 'spa', 'espanol', 'castellano', 'spanish') THEN 'es'
    WHEN l IN ('en', 'eng', 'ingles', 'english') THEN 'en'
    WHEN l IN ('ca', 'cat', 'catala', 'catalan') THEN 'ca'
    WHEN l IN ('pt', 'por', 'portugues', 'portuguese') THEN 'pt'
    WHEN l IN ('fr', 'fra', 'fre', 'francais', 'french') THEN 'fr' ELSE 'und' END, loaded_at) AS lang
  FROM spelled GROUP BY 1, 2),
  latest AS (
  SELECT lower(trim(dataset)) AS source_id, max(struct_pack(d := coalesce(
    try_strptime(trim(reg_date), '%d/%m/%Y'), try_strptime(trim(reg_date), '%Y-%m-%d')), domain := coalesce(lower(trim(domain)), ''))) AS r
  FROM resources WHERE dataset IS NOT NULL GROUP BY 1)
SELECT o.source_id, lang, coalesce(nullif(l.r.domain, ''), 'unknown') AS domain, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM once o LEFT JOIN latest l ON o.source_id = l.source_id AND o.source_id <> 'unknown'
WHERE n > 0 GROUP BY 1, 2, 3
"""

P4_FOUND = f"""
WITH r AS (
  SELECT pair_id AS id, split_name = 'train' AS train, {_words('text_es')} AS es, {_words('text_en')} AS en
  FROM parallel_biomedical
  WHERE split_name IN ('train', 'validation', 'test') AND trim(text_es) <> '' AND trim(text_en) <> ''),
  w1 AS (SELECT id, train, w, count(*) AS n FROM (SELECT id, train, unnest(es) AS w FROM r) GROUP BY ALL),
  w2 AS (SELECT id, train, w, count(*) AS n FROM (SELECT id, train, unnest(en) AS w FROM r) GROUP BY ALL),
  {_overlap('a.train AND NOT b.train', 1)},
  {_overlap('a.train AND NOT b.train', 2)}
SELECT least(x.a, x.b) AS pair_id_a, greatest(x.a, x.b) AS pair_id_b
FROM c1 x JOIN c2 y ON x.a = y.a AND x.b = y.b JOIN r ra ON ra.id = x.a JOIN r rb ON rb.id = x.b
WHERE 5 * x.common >= 4 * (len(ra.es) + len(rb.es) - x.common) AND 5 * y.common >= 4 * (len(ra.en) + len(rb.en) - y.common)
"""

P6_FOUND = f"""
WITH r AS (
  SELECT sample_id AS id, {_words("prompt || ' ' || chosen")} AS ws FROM preferences WHERE trim(prompt) <> '' AND trim(chosen) <> ''),
  w1 AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(ws) AS w FROM r) GROUP BY ALL),
  {_overlap('a.id < b.id', 1)}
SELECT x.a AS sample_id_a, x.b AS sample_id_b
FROM c1 x JOIN r ra ON ra.id = x.a JOIN r rb ON rb.id = x.b
WHERE 5 * x.common >= 4 * (len(ra.ws) + len(rb.ws) - x.common)
"""

P7_FOUND = f"""
WITH d AS (SELECT doc_id, {_words(r"regexp_replace(text, '(\p{L})[-‐‑\x{AD}][ \t]*(?:\r\n|\r|\n)\s*(\p{L})', '\1\2', 'g')")} AS ws
  FROM documents WHERE text IS NOT NULL),
  i AS (SELECT item_id, {_words('passage')} AS ws FROM eval_items WHERE passage IS NOT NULL),
  dg AS (SELECT DISTINCT doc_id, ws[k : k + 11] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 10)) AS k FROM d)),
  ig AS (SELECT DISTINCT item_id, ws[k : k + 11] AS g FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 10)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""

P8_FOUND = f"""
WITH t AS (
  SELECT {_NAME.format('source')} AS source, sum(target_share) AS share, max(max_passes) AS most FROM mix_targets GROUP BY 1),
  s AS (
  SELECT t.source, any_value(share) AS share, any_value(most) AS most, coalesce(sum({_tokens('d.text')}), 0) AS size
  FROM t LEFT JOIN documents d ON {_NAME.format('d.source')} = t.source GROUP BY 1),
  g AS (SELECT *, share * (SELECT sum(size) FROM s) AS target FROM s)
SELECT source, CASE WHEN size > 0 AND target > 0 THEN CAST(least(ceil(target / size), most) AS BIGINT) ELSE 0 END AS passes,
  CAST(most * size < target AS BIGINT) AS falls_short
FROM g
"""

P4_REPORT = f"""
WITH h AS ({P4_FOUND}),
  e AS (SELECT DISTINCT p.pair_id FROM parallel_biomedical p JOIN h ON p.pair_id IN (h.pair_id_a, h.pair_id_b) WHERE p.split_name IN ('validation', 'test'))
SELECT split_name AS split, {_NAME.format('source_id')} AS source, count(*) AS n_records, count(e.pair_id) AS n_overlapping
FROM parallel_biomedical p LEFT JOIN e ON e.pair_id = p.pair_id WHERE split_name IN ('validation', 'test') GROUP BY 1, 2
"""

P5_COVERAGE = f"""
SELECT DISTINCT source_id, id, n AS n_tokens, true AS within FROM (SELECT source_id, id, {_tokens('text')} AS n FROM corpus_rows) WHERE n > 512
"""

P6_GROUPS = f"""
WITH RECURSIVE r AS (
  SELECT sample_id AS id, list_sort({_words("prompt || ' ' || chosen")}) AS ws FROM preferences WHERE trim(prompt) <> '' AND trim(chosen) <> ''),
  m AS (SELECT id, ws, min(id) OVER (PARTITION BY ws) AS rep FROM r WHERE len(ws) > 0),
  w1 AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(ws) AS w FROM m WHERE id = rep) GROUP BY ALL),
  {_overlap('a.id < b.id', 1)},
  l AS (SELECT x.a, x.b FROM c1 x JOIN r ra ON ra.id = x.a JOIN r rb ON rb.id = x.b WHERE 5 * x.common >= 4 * (len(ra.ws) + len(rb.ws) - x.common)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  g(id, root) AS (SELECT rep, rep FROM m UNION SELECT e.b, g.root FROM g JOIN e ON e.a = g.id),
  t AS (SELECT id, min(root) AS root FROM g GROUP BY 1),
  n AS (SELECT a, count(*) AS n FROM e GROUP BY 1)
SELECT m.id AS sample_id, m.rep, t.root AS group_id, coalesce(n.n, 0) AS n_links FROM m JOIN t ON t.id = m.rep LEFT JOIN n ON n.a = m.rep
"""

P7_REMOVED = f"""
WITH d AS (SELECT doc_id, {_words(r"regexp_replace(text, '(\p{L})[-‐‑\x{AD}][ \t]*(?:\r\n|\r|\n)\s*(\p{L})', '\1\2', 'g')")} AS ws
  FROM documents WHERE text IS NOT NULL),
  i AS (SELECT {_words('passage')} AS ws FROM eval_items WHERE passage IS NOT NULL),
  dg AS (SELECT doc_id, k, ws[k : k + 11] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 10)) AS k FROM d)),
  ig AS (SELECT DISTINCT ws[k : k + 11] AS g FROM (SELECT ws, unnest(range(1, len(ws) - 10)) AS k FROM i))
SELECT doc_id, CAST(count(DISTINCT place) AS INTEGER) AS n_removed FROM (SELECT doc_id, unnest(range(k, k + 12)) AS place FROM dg SEMI JOIN ig USING (g)) GROUP BY 1
"""

P3_BALANCE = """
WITH r AS (SELECT lower(trim(metadata.model_chosen)) AS w, lower(trim(metadata.model_rejected)) AS l FROM preferences WHERE metadata.confidence BETWEEN 1 AND 10),
  g AS (SELECT * FROM r WHERE w <> '' AND l <> '' AND w <> l)
SELECT model, count(*) AS n, CAST(sum(won) AS BIGINT) AS wins, CAST(sum(won) AS DOUBLE) AS expected_wins
FROM (SELECT w AS model, 1 AS won FROM g UNION ALL SELECT l, 0 FROM g) GROUP BY 1
"""

_MIX = f"""
t AS (SELECT {_NAME.format('source')} AS source, sum(coalesce(target_share, 0)) AS share, max(greatest(coalesce(max_passes, 1), 0)) AS most FROM mix_targets GROUP BY 1),
  d AS (SELECT doc_id, {_NAME.format('source')} AS source, {_tokens('text')} AS tokens FROM documents),
  o AS (SELECT d.*, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5('7|' || doc_id), 1, 15))::BIGINT, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d WHERE tokens > 0 AND source IN (SELECT source FROM t)),
  s AS (SELECT t.source, any_value(share) AS share, any_value(most) AS most, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS size FROM t LEFT JOIN o ON o.source = t.source GROUP BY 1),
  g AS (SELECT *, share * (SELECT sum(size) FROM s) AS target FROM s),
  p AS (SELECT *, CASE WHEN size > 0 AND target > 0 THEN CAST(least(ceil(target / size), most) AS BIGINT) ELSE 0 END AS passes, CAST(ceil(size / 2048) AS BIGINT) AS blocks FROM g),
  q AS (SELECT *, CASE WHEN passes > 0 THEN least(target, most * size) - (passes - 1) * size ELSE 0 END AS rest FROM p),
  x AS (SELECT *, CAST(least(passes * blocks, greatest(passes - 1, 0) * blocks + ceil(rest / 2048)) AS BIGINT) AS slots FROM q)"""

P8_SHARES = f"""
WITH {_MIX},
  e AS (SELECT o.source, pass, tokens FROM (SELECT *, unnest(range(passes)) AS pass FROM x) y JOIN o ON o.source = y.source WHERE pass < passes - 1 OR start < rest),
  m AS (SELECT source, max(pass) + 1 AS passes, CAST(sum(tokens) AS BIGINT) AS mixed_tokens FROM e GROUP BY 1)
SELECT x.source, x.size, x.target AS target_tokens, coalesce(m.passes, 0) AS passes, CAST(most * size < target AS BIGINT) AS falls_short,
  coalesce(mixed_tokens, 0) AS mixed_tokens, coalesce(mixed_tokens / (SELECT sum(mixed_tokens) FROM m), 0) AS mixed_share
FROM x LEFT JOIN m ON m.source = x.source
"""

P8_MIX = f"""
WITH {_MIX},
  n AS (SELECT CAST(sum(slots) AS BIGINT) AS total FROM x),
  e AS (SELECT source, slots, sum(slots / total) OVER (ORDER BY source ROWS UNBOUNDED PRECEDING) AS edge, row_number() OVER (ORDER BY source DESC) = 1 AS last FROM x, n WHERE slots > 0),
  k AS (SELECT k, CAST((CAST(k AS HUGEINT) * 11400714819323198485) % 18446744073709551616 AS DOUBLE) / 18446744073709551616 AS at FROM (SELECT unnest(range(total)) AS k FROM n)),
  z AS (SELECT k, first(source ORDER BY e.source) AS source FROM k JOIN e ON e.last OR e.edge > k.at GROUP BY 1),
  r AS (SELECT k, source, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS r FROM z),
  given AS (SELECT source, count(*) AS n FROM r GROUP BY 1),
  a AS (SELECT k AS position, r.source, r FROM r JOIN x ON x.source = r.source WHERE r < slots
    UNION ALL SELECT total + r, source, r FROM (SELECT x.source, unnest(range(coalesce(given.n, 0), slots)) AS r FROM x LEFT JOIN given ON given.source = x.source WHERE slots > 0), n)
SELECT position, o.source, r // blocks AS pass, CAST(start AS BIGINT) AS start, doc_id, tokens
FROM a JOIN x ON x.source = a.source JOIN o ON o.source = a.source AND o.start // 2048 = r % blocks
WHERE r // blocks < passes - 1 OR start < rest
"""

ORACLES = {
    "p2_found": P2_FOUND, "p3_balance": P3_BALANCE, "p4_found": P4_FOUND, "p4_report": P4_REPORT, "p5_coverage": P5_COVERAGE, "p6_found": P6_FOUND, "p6_groups": P6_GROUPS,
    "p7_found": P7_FOUND, "p7_removed": P7_REMOVED, "p8_found": P8_FOUND, "p8_shares": P8_SHARES, "p8_mix": P8_MIX,
}
