"""Problem 9: pages of stuffed keywords, product tags or links.

A page is cut into segments at line ends and sentence ends. Segments with a
clause structure (enough words, and among them articles, pronouns,
conjunctions or auxiliaries, which keyword strings lack) are sentences. Where
the rest prevails, a suffix automaton over the tokens of the rest gives the
characters covered by repeated maximal substrings; a page is reported if that
coverage, with the share of links and tags and that of words in strings of
list items, shows it to be keywords and not merely short.

Stuffing may be dressed as a sentence. What looks like one counts as keywords
if an automaton over its own tokens finds it made up of substrings that occur
three times in it. Such substrings are made of pairs of words that do, so the
pairs are counted in every sentence, and the automaton is built where most of
them recur. Whole sentences that stand again are sentences.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.llm.text import map_rows

# Words that tie clauses together, in Spanish, English, Catalan, Portuguese and French.
CLAUSE_WORDS = frozenset(
    """
    qué quién cómo cuándo cuál el la los las lo un una unos unas se que y e o u ni su sus le les es son fue fueron era eran ser está están ha han había
    hay si como cuando donde cuyo cuya este esta estos estas ese esa aquel pero porque aunque mientras según sino podrá
    podrán deberá deberán debe deben puede pueden al del nos
    the an is are was were be been being has have had which that who whom this these those and or but because although
    while once no nobody it its they their he she his her we our you when where if as by
    els uns unes va van és són que qui i però perquè quan seva seu aquest aquesta dels als pel hi ho no
    os as um uma uns umas do da dos das ao à aos às foi foram não mas porque quando seu sua este esta pelo pela
    le les une des du au aux et est sont fut ont qui que dans par ce cette ces il elle ils ne pas mais où leur son sa ses
    """.split()
)

# General top-level domains; any two letters are taken for a country's.
_TOP = "com|org|net|info|edu|gov|gob|mil|int|biz|name|pro|aero|coop|museum|cat|eus|gal|io|app|dev|shop|store|online|site|web|blog|cloud|tech|xyz|club|live|news|agency|example|test"
_HOST = rf"(?:[a-z0-9-]+\.)*(?=[0-9-]*[a-z])[a-z0-9-]{{3,}}\.(?:{_TOP}|(?-i:[a-z]{{2}}))"
_URL = re.compile(rf"(?:https?://|www\.)\S+|(?<![\w@.]){_HOST}(?:[/:?#]\S*|(?![\w.]))", re.I)
_HAS_URL = re.compile(r"://|www\.|[a-z0-9-]\.[a-z]{2}", re.I)
_ANCHOR = re.compile(r"<a\b[^>]*>(.*?)</a\s*>", re.I | re.S)
_MDLINK = re.compile(r"!?\[([^\]\n]*)\]\([^)\s]*\)")
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_HASH = re.compile(r"#\w+")
_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_VERB = re.compile(r"[^\W_]{2,}(?:ó|aron|ieron|aba|aban|ía|ían|ará|arán|erá|erán|irá|irán)\b")
_END = re.compile(r"[.!?…]+[\"»”’')\]]*(?:\s+|$)")
_WRAP = re.compile(r"(?<=[^\s.!?…:;|>])[ \t]*(?:\r\n|\r|\n)[ \t]*(?=[a-záéíóúüñàèòçâêôãõ0-9(])")
_HYPHEN = re.compile(r"(?<=\w)[-\u00ad](?:\r\n|\r|\n)(?=\w)")


#: Words up to which a part without a stop is an item of a list, and items in a row that make a string of them.
ITEM_WORDS, ITEMS = 8, 3
#: Share of a sentence's characters in substrings that occur three times in it, from which on it counts as keywords.
RECURRING = 0.8


def covered(tokens: list[str], least: int = 2) -> list[bool]:
    """Which tokens lie in a substring of two tokens or more that occurs ``least`` times.

    From a suffix automaton: at each token, the longest suffix of the text so
    far that has at least so many occurrences.
    """
    step: list[dict[str, int]] = [{}]
    link = [-1]
    length = [0]
    times = [0]
    ends = []
    last = 0
    for t in tokens:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        times.append(1)
        p = last
        while p != -1 and t not in step[p]:
            step[p][t] = new
            p = link[p]
        if p != -1:
            q = step[p][t]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                times.append(0)
                link[q] = link[new] = copy
                while p != -1 and step[p].get(t) == q:
                    step[p][t] = copy
                    p = link[p]
        last = new
        ends.append(new)
    order: list[list[int]] = [[] for _ in range(len(tokens) + 1)]
    for s, n in enumerate(length):
        order[n].append(s)
    for n in range(len(tokens), 0, -1):
        for s in order[n]:
            times[link[s]] += times[s]
    out = [False] * len(tokens)
    at = len(tokens)
    for i in range(len(tokens) - 1, -1, -1):
        s = ends[i]
        while s and times[s] < least:
            s = link[s]
        if length[s] >= 2:
            for k in range(max(i - length[s] + 1, 0), min(i + 1, at)):
                out[k] = True
            at = min(at, max(i - length[s] + 1, 0))
    return out


def recurs(words: list[str]) -> bool:
    """Whether most pairs of neighbouring words stand three times or more, without which no substrings that do cover most of a text."""
    if len(words) < 20 or len(set(words)) > 0.7 * len(words):  # half the pairs, three times each, leave two thirds different
        return False
    pairs = Counter(zip(words, words[1:]))
    return 2 * sum(n for n in pairs.values() if n >= 3) > len(words) - 1


def page_profile(text: str) -> dict[str, float]:
    """Words in sentences and in the rest; of the rest, the share of links, of words in strings of items, and the repeated coverage in characters."""
    if "-\n" in text or "-\r" in text or "\u00ad" in text:
        text = _HYPHEN.sub("", text)
    links = 0
    linked: list[str] = []

    def anchor(m: re.Match) -> str:
        linked.append(m.group(1))
        return f"\n\x02{m.group(1)}\n"

    if "<a" in text or "<A" in text:
        text = _ANCHOR.sub(anchor, text)
    if "](" in text:
        text = _MDLINK.sub(lambda m: "\n" if m.group(0)[0] == "!" else anchor(m), text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if _HAS_URL.search(text):
        text, urls = _URL.subn(" \x01 ", text)
        links += urls
    if "#" in text:
        text, tags = _HASH.subn(" \x01 ", text)
        links += tags
    text = _WRAP.sub(" ", text)
    parts: list[tuple[str, int, bool]] = []  # of each part, its words and whether it is a sentence
    listed = run = many = 0
    for line in text.splitlines():
        of_link = line.startswith("\x02")
        at = 0
        while at < len(line):
            m = _END.search(line, at)
            to = m.end() if m else len(line)
            part = line[at:to]
            at = to
            words = _WORD.findall(part.lower())
            n = len(words)
            if not n:
                parts.append((part, 0, False))
                continue
            ties = sum(1 for w in words if w in CLAUSE_WORDS)
            bars = part.count(",") + part.count(";") + part.count("|")
            few_bars = bars <= n / 4
            is_sentence = not of_link and few_bars and (n >= 6 and ties >= 2 and ties / n >= 0.08 or n >= 8 and m is not None and ties + len(_VERB.findall(part)) >= 1)
            if is_sentence and recurs(words):
                tokens = _tokens(part)
                is_sentence = sum(len(t) for t, m in zip(tokens, covered(tokens, 3)) if m) < RECURRING * sum(map(len, tokens))
            parts.append((part, n, is_sentence))
            if not is_sentence and (n <= ITEM_WORDS and not m or not few_bars):
                run += n
                many += 1 if few_bars else bars + 1
            else:
                listed += run if many >= ITEMS else 0
                run = many = 0
    listed += run if many >= ITEMS else 0
    sentence = sum(n for _, n, is_sentence in parts if is_sentence)
    rest = sum(n for _, n, is_sentence in parts if not is_sentence)
    anchors = sum(len(_WORD.findall(x)) for x in linked)
    out = {"sentence_words": sentence, "other_words": rest + links, "links": links + len(linked), "link_words": links + anchors, "listed_words": listed, "coverage": 0.0}
    if out["other_words"] > sentence:
        tokens = _tokens(" ".join(part for part, _, is_sentence in parts if not is_sentence))
        marks = covered(tokens)
        total = sum(map(len, tokens))
        out["coverage"] = sum(len(t) for t, m in zip(tokens, marks) if m) / total if total else 0.0
    return out


def _tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower().replace("\x01", " ").replace("\x02", " "))


def keyword_pages(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_stuffed: float = 0.25,
    min_words: int = 10,
) -> DataFrame:
    """(doc_id, sentence_words, other_words, link_words, listed_words, coverage, is_spam) for each document with a text.

    ``is_spam``: the words outside sentences prevail and number at least
    ``min_words``, or at least ITEMS links are among them; and the share of
    links and tags, plus that of words in strings of list items, plus the
    share of the other characters that recurring substrings cover, reaches
    ``min_stuffed``. Null texts give no row; empty and blank ones give zeros
    and false; repeated rows are repeated. Other columns are ignored.
    """
    id_type = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, sentence_words int, other_words int, link_words int, listed_words int, coverage double, is_spam boolean"
    figures = ("sentence_words", "other_words", "link_words", "listed_words", "coverage")

    def profile(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {id_column: rows[id_column], **{n: [] for n in figures}, "is_spam": []}
        for text in rows[text_column]:
            p = page_profile(text)
            for name in figures:
                out[name].append(p[name])
            n = p["other_words"]
            enough = n > p["sentence_words"] and (n >= min_words or p["links"] >= ITEMS)
            out["is_spam"].append(enough and (p["link_words"] + p["listed_words"]) / n + p["coverage"] >= min_stuffed)
        return out

    return map_rows(documents.where(F.col(text_column).isNotNull()).select(id_column, text_column), profile, schema)
