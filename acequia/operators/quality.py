"""Document quality rules after Gopher and FineWeb, as columns of reasons.

Line rules are column expressions; n-gram rules need counts of runs of words,
which Arrow functions work out by document.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from acequia.operators.filters import reasons


def _lines(c: Column) -> Column:
    return F.filter(F.split(c, r"\r\n|\n|\r"), lambda x: F.trim(x) != "")


def line_stats(c: Column, short: int = 30) -> dict[str, Column]:
    """Shares of a text's lines: repeated, ending in punctuation, short, and characters of repeated ones."""
    lines = _lines(c)
    n = F.size(lines)
    share = lambda part: F.when(n > 0, part / n).otherwise(F.lit(0.0))
    chars = lambda x: F.aggregate(x, F.lit(0), lambda s, y: s + F.length(y))
    unique = F.array_distinct(lines)
    words = F.regexp_count(c, F.lit(r"\S+"))
    return {
        "repeated_lines": share(n - F.size(unique)),
        "punctuated_lines": share(F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?…]$")))),
        "short_lines": share(F.size(F.filter(lines, lambda x: F.length(x) <= short))),
        "repeated_chars": F.when(F.length(c) > 0, (chars(lines) - chars(unique)) / F.length(c)).otherwise(F.lit(0.0)),
        "breaks_per_word": F.when(words > 0, F.regexp_count(c, F.lit(r"\n")) / words).otherwise(F.lit(0.0)),
    }


def web_reasons(c: Column, punctuated: float = 0.1, short: float = 0.67, repeated: float = 0.35, breaks: float = 1.0) -> Column:
    s = line_stats(c)
    return reasons(
        line_punctuation=s["punctuated_lines"] <= punctuated,
        short_lines=s["short_lines"] > short,
        repeated_characters=s["repeated_chars"] > repeated,
        line_breaks=s["breaks_per_word"] > breaks,
    )


# Frequent words of Spanish.
STOP_WORDS = "el la los las de del que y en un una por con para se su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde".split()


def document_reasons(c: Column, least: int = 0, most: int = 1_000_000, shortest: float = 2, longest: float = 16, alphabetic: float = 0.3, stop_words: int = 2, listed: list[str] | None = None) -> Column:
    """Number and mean length of words, share of words with a letter, and different stop words."""
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    n = F.size(words)
    mean = F.when(n > 0, F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w)) / n).otherwise(F.lit(0.0))
    lettered = F.when(n > 0, F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) / n).otherwise(F.lit(0.0))
    found = F.array_intersect(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1)), F.array(*[F.lit(w) for w in listed or STOP_WORDS]))
    return reasons(
        word_count=~n.between(least, most),
        word_length=~mean.between(shortest, longest),
        alphabetic_words=lettered < alphabetic,
        stop_words=F.size(found) < stop_words,
    )


def gram_shares(text: str | None, top: tuple[int, ...] = (3, 4, 5), repeated: tuple[int, ...] = (3, 4, 5)) -> dict[str, float]:
    """Characters of the most frequent n-gram times its count, and those covered by n-grams seen before, by all characters."""
    words = (text or "").split()
    size = max(1, len(text or ""))
    out = {}
    for n in top:
        count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        most = max(count.items(), key=lambda x: (x[1], len(" ".join(x[0]))), default=None)
        out[f"top_{n}"] = len(" ".join(most[0])) * most[1] / size if most and most[1] > 1 else 0.0
    for n in repeated:
        seen: set[tuple[str, ...]] = set()
        i = chars = 0
        while i <= len(words) - n:
            gram = tuple(words[i : i + n])
            if gram in seen:
                chars += sum(map(len, gram))
                i += n
            else:
                seen.add(gram)
                i += 1
        out[f"repeated_{n}"] = chars / size
    return out


TOP_LIMITS = {3: 0.6, 4: 0.55, 5: 0.4}
REPEATED_LIMITS = {3: 0.75, 4: 0.65, 5: 0.55}


def repetition_reasons(c: Column, lines: float = 0.35, top: dict[int, float] = TOP_LIMITS, repeated: dict[int, float] = REPEATED_LIMITS) -> Column:
    """Repeated lines, a dominant n-gram, and text covered by repeated n-grams."""

    @F.pandas_udf("array<string>")
    def grams(s: pd.Series) -> pd.Series:
        def name(t: str | None) -> list[str]:
            x = gram_shares(t, tuple(top), tuple(repeated))
            return [f"top_{n}_grams" for n, v in top.items() if x[f"top_{n}"] > v] + [f"repeated_{n}_grams" for n, v in repeated.items() if x[f"repeated_{n}"] > v]

        return s.map(name)

    return F.concat(reasons(repeated_lines=line_stats(c)["repeated_lines"] > lines), grams(c))
