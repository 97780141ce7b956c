"""Queries of readers and writers, each over tables written first, and of what belongs to them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from acequia.functions import dates, jsontext
from acequia.functions import text as X
from acequia.operators import chunking, filters, projection
from acequia.operators.minhash import minhash_groups
from acequia.plans.text_queries import docs, read
from acequia.session import checkpoint_root
from acequia.sources import readers, writers


def _place(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/acequia/{name}-{uuid.uuid4().hex}"


def _lines(spark, d):
    """Responses as JSON lines, every seventh cut off in its middle."""
    rows = read(spark, d, "responses").select("prompt_id", "model", "response").distinct()
    line = F.to_json(F.struct("prompt_id", "model", "response"), {"ignoreNullFields": "false"})
    return rows.select(F.when(F.col("prompt_id") % 7 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value"))


def parquet_tree_scan(spark, d):
    root = _place(spark, "tree")
    docs(spark, d).select("doc_id", "source", "lang").write.parquet(f"{root}/a/deep")
    read(spark, d, "documents").select((F.col("doc_id") + 10_000_000).alias("doc_id"), "source", F.lit(1).alias("extra")).write.parquet(f"{root}/b")
    return readers.parquet_tree(spark, root, ["doc_id", "source", "lang"])


def jsonl_gzip_scan(spark, d):
    path = _place(spark, "gz")
    docs(spark, d).select("doc_id", "source").write.option("compression", "gzip").json(path)
    return readers.jsonl(spark, path, "doc_id bigint, source string")


def jsonl_bad_dropped(spark, d):
    path = _place(spark, "lines")
    _lines(spark, d).write.text(path)
    return readers.jsonl(spark, path, "prompt_id bigint, model string, response string", bad="drop").select("prompt_id", "model")


def jsonl_bad_captured(spark, d):
    path = _place(spark, "lines")
    _lines(spark, d).write.text(path)
    rows = readers.jsonl_captured(spark, path, "prompt_id bigint, model string, response string")
    return rows.groupBy("_invalid_json").agg(F.count("*").alias("n"), F.count("response").alias("n_responses"))


def yearly_tables(spark, d):
    root = _place(spark, "years")
    for year, lang in (("2021", "es"), ("2022", "en")):
        docs(spark, d).where(F.col("lang") == lang).select("doc_id", "source").write.parquet(f"{root}/{year}_docs.parquet")
    return readers.year_union(spark, [f"{root}/2021_docs.parquet", f"{root}/2022_docs.parquet"], prefix=True)


def consolidated_tables(spark, d):
    name = F.concat_ws("_", F.lit("ds"), F.coalesce(F.substring("doc_date", 1, 10), F.lit("x")), F.concat(F.lit("n"), F.col("doc_id") % 1000), F.lit("leg14"))
    old = docs(spark, d).where(F.col("doc_id") % 2 == 0).select(name.alias("identificador"), F.col("source").alias("fuente"))
    new = docs(spark, d).where(F.col("doc_id") % 2 == 1).select(name.alias("id"), "source")
    return readers.consolidate([old, new], {"identificador": "id", "fuente": "source"}).select("id", "source", "date", "number", "legislature")


def answers_by_annotator(spark, d):
    wide = read(spark, d, "eval_items").select("item_id", F.col("answer").alias("Respuesta [ana]"), F.col("difficulty").alias("Respuesta [luis]"), "asker")
    return readers.wide_answers(wide, "item_id", r"^Respuesta \[(\w+)\]$")


def sharded_rows(spark, d):
    return readers.sharded(docs(spark, d).select("doc_id"), ["doc_id"], 4)


def twin_restored(spark, d):
    path = _place(spark, "twin")
    rows = docs(spark, d).select("doc_id", "source")
    rows.write.parquet(f"{path}.parquet")
    first, second = writers.write_twin(rows.limit(0), path), writers.write_twin(rows.limit(0), path)
    return readers.jsonl(spark, f"{path}.jsonl", "doc_id bigint, source string").select("doc_id", "source", F.lit(first).alias("wrote"), F.lit(second).alias("wrote_again"))


def tagged_union(spark, d):
    tables = {"docs": docs(spark, d).selectExpr("doc_id as id", "text"), "pairs": read(spark, d, "parallel_biomedical").selectExpr("pair_id as id", "text_es as text")}
    return writers.tagged(tables).groupBy("source").agg(F.count("*").alias("n"), F.count("text").alias("n_texts"), F.countDistinct("id").alias("n_ids"))


def named_by_task(spark, d):
    sources = [r[0] for r in docs(spark, d).where("source = lower(source)").select("source").distinct().orderBy("source").limit(2).toLocalIterator()]
    root = _place(spark, "task")
    path = writers.task_path(root, "tokens_general", sources, 1000)
    docs(spark, d).select("doc_id").write.parquet(f"{path}.parquet")
    rows = spark.read.parquet(f"{path}.parquet").withColumn("name", F.lit(path.rsplit("/", 1)[-1]))
    return projection.from_file_name(rows, ["a", "b"], F.lit("tokens-general.parquet")).groupBy("name", "a", "b").agg(F.count("*").alias("n"))


def prompt_safe_texts(spark, d):
    t = F.concat(F.lit('<think>x "y"</think>\n'), F.coalesce("text", F.lit("")), F.lit("\t“z”</THINK>"))
    return docs(spark, d).select("doc_id", F.md5(X.prompt_safe(t)).alias("safe_md5"), F.md5(X.strip_thinking(F.concat(F.lit("<think>a\nb</think>"), F.coalesce("source", F.lit("")), F.lit("</Think>")))).alias("said_md5"))


def judge_verdicts(spark, d):
    meta = read(spark, d, "preferences").select("sample_id", F.col("metadata.confidence").alias("c"))
    text = (
        F.when(F.col("sample_id") % 3 == 0, F.concat(F.lit('Veredicto: {"winner": "a", "confidence": '), F.coalesce(F.col("c").cast("string"), F.lit("null")), F.lit(', "reason": "r"} fin')))
        .when(F.col("sample_id") % 3 == 1, F.lit("El ganador es B."))
        .otherwise(F.lit("No lo sé"))
    )
    return meta.select("sample_id", jsontext.verdict(text).alias("v")).select("sample_id", "v.winner", "v.confidence", "v.reason")


def bounded_fields(spark, d):
    rows = read(spark, d, "eval_items")
    return rows.select("item_id", F.array_join(jsontext.field_errors({"question": (20, 80), "answer": (1, 60), "asker": (None, 10)}), ",").alias("errors"))


def durations(spark, d):
    n = F.col("doc_id")
    text = F.when(n % 5 == 0, F.lit("P1D")).otherwise(F.concat(F.lit("PT"), F.when(n % 2 == 0, F.concat(n % 30, F.lit("H"))).otherwise(""), (n % 60).cast("string"), F.lit("M"), (n * 7 % 60).cast("string"), F.lit("S")))
    return docs(spark, d).select("doc_id", dates.clock(text).alias("clock"))


def refused_answers(spark, d):
    rows = read(spark, d, "responses").where("response is not null").select("prompt_id", "model", "response").distinct()
    return rows.select("prompt_id", "model", F.md5("response").alias("response_md5"), filters.refuses(F.col("response")).alias("refuses"))


def shingle_groups(spark, d):
    return minhash_groups(read(spark, d, "preferences"), "prompt", "sample_id", shingle=5).select("id", "group_id", "kept")


def sentence_windows(spark, d):
    return chunking.sentence_context(docs(spark, d), "doc_id", "text").groupBy("id").agg(F.count("*").alias("n"), F.sum(F.length("sentence")).alias("chars"), F.sum(F.length("context")).alias("context_chars"))


def _groups_sql(table: str, key: str, text: str, n: int) -> str:
    """Groups of texts of a shingle similarity of .8 or more, n words a shingle."""
    return rf"""WITH RECURSIVE t AS (SELECT {key} AS id, regexp_extract_all(nfc_normalize(lower({text})), '[\p{{L}}\p{{N}}]+') AS w, {text} AS x FROM {table} WHERE {text} IS NOT NULL),
      f AS (SELECT min(id) AS id, any_value(w) AS w FROM t GROUP BY x),
      g AS (SELECT DISTINCT id, w[k : k + {n - 1}] AS s FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS k FROM f)),
      n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
      h AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b USING (s) JOIN n x ON x.id = a.id JOIN n y ON y.id = b.id WHERE a.id < b.id
        GROUP BY 1, 2, x.n, y.n HAVING 5 * count(*) >= 4 * (x.n + y.n - count(*))),
      l AS (SELECT a, b FROM h UNION SELECT b, a FROM h),
      r(id, root) AS (SELECT id, id FROM f UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
      c AS (SELECT f.id, min(root) AS root FROM f JOIN r USING (id) GROUP BY 1),
      p AS (SELECT t.id, c.root AS group_id, t.id = c.root AS kept FROM t JOIN (SELECT min(id) AS first, x FROM t GROUP BY x) y USING (x) JOIN c ON c.id = y.first)
      SELECT"""


_REFUSALS = " OR ".join(f"starts_with(x, '{p}')" for p in filters.REFUSAL_PREFIXES)

ORACLES = {
    "parquet_tree_scan": "SELECT doc_id, source, lang FROM documents UNION ALL SELECT doc_id + 10000000, source, NULL FROM documents",
    "jsonl_gzip_scan": "SELECT doc_id, source FROM documents",
    "jsonl_bad_dropped": "SELECT prompt_id, model FROM (SELECT DISTINCT prompt_id, model, response FROM responses) WHERE prompt_id % 7 <> 0",
    "jsonl_bad_captured": """SELECT prompt_id % 7 = 0 AS _invalid_json, count(*) AS n, count(CASE WHEN prompt_id % 7 <> 0 THEN response END) AS n_responses
      FROM (SELECT DISTINCT prompt_id, model, response FROM responses) GROUP BY 1""",
    "yearly_tables": "SELECT doc_id, source, CASE lang WHEN 'es' THEN '2021' ELSE '2022' END AS year FROM documents WHERE lang IN ('es', 'en')",
    "answers_by_annotator": """SELECT item_id AS item, 'ana' AS annotator, answer FROM eval_items WHERE trim(answer) <> ''
      UNION ALL SELECT item_id, 'luis', difficulty FROM eval_items WHERE trim(difficulty) <> ''""",
    "sharded_rows": "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM documents",
    "twin_restored": "SELECT doc_id, source, true AS wrote, false AS wrote_again FROM documents",
    "tagged_union": """SELECT 'docs' AS source, count(*) AS n, count(text) AS n_texts, count(DISTINCT doc_id) AS n_ids FROM documents
      UNION ALL SELECT 'pairs', count(*), count(text_es), count(DISTINCT pair_id) FROM parallel_biomedical""",
    "named_by_task": """WITH s AS (SELECT DISTINCT source FROM documents WHERE source = lower(source) ORDER BY source LIMIT 2)
      SELECT 'tokens-general--' || (SELECT string_agg(replace(source, ' ', '_'), '-' ORDER BY source) FROM s) || '--1000' AS name, 'tokens' AS a, 'general' AS b, count(*) AS n FROM documents""",
    "prompt_safe_texts": r"""SELECT doc_id, md5(regexp_replace(translate(translate('<think>x "y"</think>' || chr(10) || coalesce(text, '') || chr(9) || '“z”</THINK>', '"“”«»`', ''''''''''''''), chr(13) || chr(10) || chr(9), '   '), '[\x00-\x1f\x7f]', '', 'g')) AS safe_md5,
      md5(trim(coalesce(source, ''))) AS said_md5 FROM documents""",
    "judge_verdicts": """SELECT sample_id, CASE sample_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS winner, CASE sample_id % 3 WHEN 0 THEN coalesce(metadata.confidence, 5) WHEN 1 THEN 5 END AS confidence,
      CASE sample_id % 3 WHEN 0 THEN 'r' END AS reason FROM preferences""",
    "bounded_fields": """SELECT item_id, concat_ws(',', CASE WHEN question IS NULL THEN 'question_missing' WHEN length(question) < 20 THEN 'question_short' WHEN length(question) > 80 THEN 'question_long' END,
      CASE WHEN answer IS NULL THEN 'answer_missing' WHEN length(answer) < 1 THEN 'answer_short' WHEN length(answer) > 60 THEN 'answer_long' END,
      CASE WHEN asker IS NULL THEN 'asker_missing' WHEN length(asker) > 10 THEN 'asker_long' END) AS errors FROM eval_items""",
    "durations": """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN (s // 3600) || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') END AS clock
      FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id % 30 * 3600 ELSE 0 END + doc_id % 60 * 60 + doc_id * 7 % 60 AS s FROM documents)""",
    "refused_answers": rf"""SELECT DISTINCT prompt_id, model, md5(response) AS response_md5, {_REFUSALS} AS refuses
      FROM (SELECT *, regexp_replace(lower(response), '^[^\p{{L}}]+', '') AS x FROM responses WHERE response IS NOT NULL)""",
    "shingle_groups": f"{_groups_sql('preferences', 'sample_id', 'prompt', 5)} id, group_id, kept FROM p",
    "minhash_short": f"{_groups_sql('preferences', 'sample_id', 'prompt', 3)} id, group_id, kept FROM p",
    "minhash_dedup": f"{_groups_sql('documents', 'doc_id', 'text', 5)} doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM p WHERE NOT kept)",
    "character_runs": "SELECT doc_id FROM (SELECT DISTINCT doc_id FROM (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS grp, ch FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM documents WHERE text IS NOT NULL)) WHERE ch NOT IN (chr(10), chr(13)) GROUP BY doc_id, ch, grp HAVING count(*) > 10)",
    "emoji_only": r"SELECT doc_id FROM documents WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> '' AND regexp_replace(regexp_replace(text, '[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}]+', '', 'g'), '[\p{Z}\p{P}\p{S}]', '', 'g') = ''",
    "prompt_validity": r"""SELECT DISTINCT prompt_id, model, length(b) BETWEEN 20 AND 400 AND regexp_matches(b, '[\p{L}\p{N}]') AS valid
      FROM (SELECT prompt_id, model, trim(regexp_replace(regexp_replace(response, '<think>.*?</think>', '', 'gsi'), '</?think>', '', 'gi'), ' ') AS b FROM responses)""",
}

QUERIES = {
    f.__name__: f
    for f in (
        parquet_tree_scan, jsonl_gzip_scan, jsonl_bad_dropped, jsonl_bad_captured, yearly_tables, consolidated_tables, answers_by_annotator, sharded_rows, twin_restored, tagged_union,
        named_by_task, prompt_safe_texts, judge_verdicts, bounded_fields, durations, refused_answers, shingle_groups, sentence_windows,
    )
}
