"""Problem 5: splitting oversized texts at natural boundaries.

Natural boundaries are line breaks and the ends of sentences. At each of them
the words of the blocks on both sides are compared; the valleys of that
similarity mark where the topic changes. Within the window of a piece the
deepest valley is taken, and the next piece begins up to ``overlap`` tokens
before the cut, again at a natural boundary if there is one.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.llm.text import TOKEN, map_rows, token_count

# Abbreviations whose point doesn't end a sentence, folded to lower case.
ABBREVIATIONS = frozenset(
    """
    art arts núm núms num nº pág págs pag pags pp vid vol vols ss sig sigs sr sra sres sras srta dr dra dres dras dña prof profª
    ing lic lcdo lcda ilmo ilma excmo excma mons rvdo sto sta fr hno hnos av avda ctra pza apdo cap caps cf cfr ej ap
    ed eds fig figs tab tel teléf tfno fax vda vto fdo ee uu rr hh dd ff cía cia ltda ltd inc co corp mr mrs ms mme mlle jr
    vs op cit cits ibid ibíd íd obs ref refs reg sec secc tít tit trad ud uds vd vds fol fols exp expte rd lo bo disp
    aprox máx mín admón dpto depto gral gob pte ppal prov izq dcha dpdo bco edif km² nov pàg pàgs núms dn
    """.split()
)

_BREAK = re.compile(r"(?:\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])\s*")
_STOP = re.compile(r"([.!?…]+)[\"»”’'\)\]\}›]*\s+")
_LAST = re.compile(r"[^\s\"«“‘'(\[{‹¿¡,;:|/–—]+$")


def ends_sentence(text: str, at: int, marks: str, after: int) -> bool:
    """Whether stop marks at a place of the text, with white space after them, end a sentence.

    A point doesn't after an abbreviation, an initial or a number that numbers
    a line or goes on in lower case or digits, nor after a word so short that
    it may be an abbreviation too where the text goes on in lower case.
    """
    if marks != ".":
        return True
    m = _LAST.search(text, max(0, at - 40), at)
    word = m.group() if m else ""
    follows = text[after : after + 1]
    if not word:
        return not follows.islower()
    if len(word) == 1 and word.isalpha():
        return False
    if "." in word and not word[-1].isdigit() and all(len(x) <= 2 for x in word.split(".")):
        return False
    if word.lower() in ABBREVIATIONS:
        return False
    if word.isdigit():
        head = text[max(0, m.start() - 8) : m.start()]
        if not head.strip() and (m.start() == 0 or "\n" in head or "\r" in head):
            return False
        return not (follows.islower() or follows.isdigit())
    return len(word) > 4 or not follows.islower()


def boundaries(text: str) -> list[int]:
    """Places of the natural boundaries, both ends among them: where the text after each begins."""
    places = {0, len(text)}
    places.update(m.end() for m in _BREAK.finditer(text))
    places.update(m.end() for m in _STOP.finditer(text) if ends_sentence(text, m.start(), m.group(1), m.end()))
    return sorted(places)


def _cosine(a: Counter, b: Counter) -> float:
    dot = sum(n * b[w] for w, n in a.items() if w in b)
    if not dot:
        return 0.0
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


def similarities(tokens: list[str], at: list[int], block: int) -> list[float]:
    """Similarity of the blocks of tokens on the two sides of each boundary."""
    words = [t.lower() if len(t) > 3 else "" for t in tokens]
    near = []
    for k in at:
        before, after = ([w for w in part if w] for part in (words[max(0, k - block) : k], words[k : k + block]))
        near.append(_cosine(Counter(before), Counter(after)) if before and after else 0.0)
    return near


def depths(tokens: list[str], at: list[int], block: int) -> list[float]:
    """Depth of the similarity valley at each boundary."""
    near = similarities(tokens, at, block)
    left, right = near[:], near[:]
    for i in range(1, len(near)):  # the peak on a side: as far as the similarity doesn't fall
        if near[i - 1] >= near[i]:
            left[i] = left[i - 1]
    for i in range(len(near) - 2, -1, -1):
        if near[i + 1] >= near[i]:
            right[i] = right[i + 1]
    return [a + b - 2 * s for a, b, s in zip(left, right, near)]


def cut(text: str, max_tokens: int, overlap: int, block: int = 64) -> list[tuple[int, int, int, int, bool]]:
    """Pieces of a text: (begin, end, tokens, tokens shared with the piece before, whether the end is natural).

    Every piece has at most ``max_tokens`` tokens; its end is natural unless
    the stretch from one natural boundary to the next alone has more.
    """
    spans = [m.span() for m in TOKEN.finditer(text)]
    total = len(spans)
    if total <= max_tokens:
        return [(0, len(text), total, 0, True)]
    firsts = [a for a, _ in spans]
    natural = sorted({bisect_left(firsts, p) for p in boundaries(text)} | {0, total})
    depth = depths([text[a:b] for a, b in spans], natural, block)
    out = []
    begin = done = 0
    while True:
        limit = begin + max_tokens
        if limit >= total:
            out.append((begin, total, done - begin, True))
            break
        hi = bisect_right(natural, limit)
        lo = max(bisect_right(natural, done), bisect_left(natural, min(limit, done + (limit - done) // 2)))
        if lo >= hi:
            lo = max(bisect_right(natural, done), hi - 1)
        if lo < hi:
            k = max(range(lo, hi), key=lambda i: (depth[i], natural[i]))
            end, is_natural = natural[k], True
        else:
            end, is_natural = limit, False
        out.append((begin, end, done - begin, is_natural))
        later = natural[bisect_right(natural, end)]
        least = max(end - overlap, done, begin + 1, min(end, later - max_tokens) if later - end <= max_tokens else 0)
        i = bisect_left(natural, least)
        begin = natural[i] if natural[i] < end else least
        done = end
    place = lambda k: spans[k][0] if k < total else len(text)
    return [(0 if a == 0 else place(a), place(b), b - a, shared, ok) for a, b, shared, ok in out]


def split_oversized(
    rows: DataFrame,
    *,
    key_columns: tuple[str, ...] = ("source_id", "id"),
    text_column: str = "text",
    max_tokens: int = 512,
    overlap: int = 64,
) -> DataFrame:
    """(keys, piece_no, begin, end, piece, n_tokens, n_shared, cut_kind) of each text of more than ``max_tokens`` tokens.

    ``begin`` and ``end`` are characters of the text; ``cut_kind`` says
    whether the piece ends at a natural boundary. Other rows, null and empty
    texts among them, give no pieces; repeated rows give repeated pieces.
    Other columns are ignored. Texts of any length are taken whole.
    """
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{k}` {types[k]}" for k in key_columns) + ", piece_no int, begin int, `end` int, piece string, n_tokens int, n_shared int, cut_kind string"
    names = [*key_columns, "piece_no", "begin", "end", "piece", "n_tokens", "n_shared", "cut_kind"]

    def run(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in names}
        for i, text in enumerate(batch[text_column]):
            pieces = cut(text, max_tokens, overlap)
            if len(pieces) < 2:
                continue
            for no, (a, b, n, shared, natural) in enumerate(pieces):
                for k in key_columns:
                    out[k].append(batch[k][i])
                for name, x in zip(names[len(key_columns) :], (no, a, b, text[a:b], n, shared, "natural" if natural else "forced")):
                    out[name].append(x)
        return out

    long = rows.select(*key_columns, text_column).where(token_count(text_column) > max_tokens)
    return map_rows(long, run, schema)


def cut_kinds(pieces: DataFrame, key: str = "id") -> DataFrame:
    """(id, cut_kind): ``forced`` if any piece of the id had to be cut within a stretch, else ``natural``."""
    return pieces.groupBy(key).agg(F.min("cut_kind").alias("cut_kind"))
