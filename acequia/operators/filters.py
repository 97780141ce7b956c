"""Filters as columns of reasons, so that rejected rows can be kept with theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions import text as X


def reasons(**tests: Column) -> Column:
    """Names of the tests that hold, in order; a test that is null doesn't."""
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))


def kept(df: DataFrame, column: str = "reasons") -> DataFrame:
    return df.where(F.size(column) == 0)


def rejected(df: DataFrame, column: str = "reasons") -> DataFrame:
    return df.where(F.size(column) > 0)


def spam_reasons(c: Column, urls: int = 1, mentions: int = 3, run: int = 10, symbols: float = 0.6, with_runs: bool = True) -> Column:
    """What makes a comment spam: links, mentions, runs of one character, too many symbols."""
    tests = {"urls": X.url_count(c) > urls, "mentions": X.mention_count(c) > mentions, "symbols": X.symbol_share(c) > symbols}
    if with_runs:
        tests["runs"] = X.has_run(c, run)
    return reasons(**tests)


def comment_reasons(body: Column, title: Column, description: Column) -> Column:
    """What keeps a comment out of a stance corpus."""
    return reasons(
        no_text=body.isNull(),
        no_letter=~body.rlike(X.LETTER),
        just_url=X.just_url(body),
        welcome=body.rlike("(?i)bienvenido"),
        listing=body.rlike(r"(?i)(listado.*no.repetidas|no.repetidas.*listado|propuestas.*no.repetidas)"),
        questions=title.rlike(r"(?i)#T[uú]Preguntas"),
        no_description=F.length(F.coalesce(description, F.lit(""))) == 0,
    )


def fit_for_sample(body: Column, description: Column, least: int = 50, most: int = 1000, words: int = 5, described: int = 30) -> Column:
    """Long and short enough, with words, without links, and described by more than a link."""
    n = F.size(F.filter(F.split(F.trim(body), r"\s+"), lambda w: w != ""))
    bare = F.length(F.trim(F.regexp_replace(F.coalesce(description, F.lit("")), r"https?://\S+", "")))
    return F.length(body).between(least, most) & (n >= words) & ~body.rlike(r"https?://") & (bare >= described)


def prompt_valid(c: Column, least: int = 10, most: int = 2000) -> Column:
    """A generated prompt of a fit length with a letter or digit, after its thinking is taken out."""
    bare = X.strip_thinking(c)
    return F.length(bare).between(least, most) & bare.rlike(r"[\p{L}\p{N}]")


# How answers begin that show a model's reasoning.
REASONING_TAG = r"(?i)^\s*<think"
REASONING_WORDS = r"(?i)^\s*(?:okay|ok|alright|let me|hmm|vale|veamos|bueno),?\b"


def reasoning_counts(df: DataFrame, chosen: str = "chosen", rejected_: str = "rejected") -> DataFrame:
    """Rows, and those whose chosen, rejected or both answers begin with reasoning."""
    starts = lambda c: F.coalesce(F.col(c).rlike(REASONING_TAG) | F.col(c).rlike(REASONING_WORDS), F.lit(False))
    a, b = starts(chosen), starts(rejected_)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(a).alias("in_chosen"), F.count_if(b).alias("in_rejected"), F.count_if(a & b).alias("in_both"), F.count_if(a | b).alias("in_any"))


def dotted_chunk(c: Column, most: float = 0.1) -> Column:
    """Whether full stops make up less than a share of a chunk's characters."""
    return F.when(F.length(c) > 0, F.regexp_count(c, F.lit(r"\.")) / F.length(c)).otherwise(F.lit(0.0)) < most


def within_tokens(n: Column, least: int, most: int, slack: int = 128) -> Column:
    return n.between(least, most + slack)


def title_and_date(df: DataFrame, title: str, published: str, words: list[str], since: str, until: str, first: int, order: list[str]) -> DataFrame:
    """Rows whose title has one of the words, in the period or with no readable date; the first of them in order."""
    key = X.match_key(F.col(title))
    named = F.lit(False)
    for w in words:
        named = named | F.contains(key, X.match_key(F.lit(w)))
    day = F.try_to_timestamp(F.col(published)).cast("date")
    return df.where(named & (day.isNull() | day.between(F.lit(since).cast("date"), F.lit(until).cast("date")))).orderBy(*order).limit(first)


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with no null among the columns."""
    return df.dropna(how="any", subset=columns)


def not_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose columns all have something besides blanks."""
    for c in columns:
        df = df.where(F.trim(c) != "")
    return df


def language_score(c: Column, frequent: list[str]) -> Column:
    """Share of words that are among a language's frequent ones: a stand-in where no model is given."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1))
    hits = F.size(F.filter(found, lambda w: w.isin(frequent)))
    return F.when(F.size(found) > 0, hits / F.size(found)).otherwise(F.lit(0.0))


# How an answer begins that declines, lower case.
REFUSAL_PREFIXES = (
    "lo siento", "lo lamento", "lamento no poder", "no puedo ayudar", "no puedo responder", "no puedo proporcionar", "no me es posible", "no estoy autorizad", "como modelo de lenguaje", "como asistente virtual",
    "i am sorry", "sorry", "i cannot", "i am unable", "as an ai", "je suis désolé", "je ne peux pas", "não posso", "ho sento", "no puc ajudar",
)


def refuses(c: Column) -> Column:
    """Whether an answer begins with a refusal, quotes and marks before it left aside; false of a null."""
    bare = F.regexp_replace(F.lower(c), r"^[^\p{L}]+", "")
    out = F.lit(False)
    for prefix in REFUSAL_PREFIXES:
        out = out | F.startswith(bare, F.lit(prefix))
    return F.coalesce(out, F.lit(False))


def near_question(question: Column, answer: Column, least: float = 0.5) -> Column:
    """Whether the vectors of question and answer have a cosine of ``least`` or more; false of a null or a zero vector."""
    from acequia.functions.measures import cosine

    return F.coalesce(cosine(question, answer) >= least, F.lit(False))
