"""Text functions as column expressions that stay in the JVM.

All take and give Columns; a null text gives null unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the corpus's cleaning steps and filters.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x{85}]"
IMAGE = r"(?d)!\[.*?\]\(.*?\)"
NEWLINES = r"[\r\n]{2,}"
WIKI_HEADING = r"(?dm)^\s*=+\s*(.+?)\s*=+\s*$"
OPEN_LINE = r"""([^\s\.,;:!?\)\]\}\"'»”])\r?\n\s*([A-ZÁÉÍÓÚÜÑ])"""
URL = r"https?://\S+|www\.\S+"
MENTION = r"@[\p{L}\p{N}_]+"
MENTION_NAME = r"@[\p{L}\p{N}_\.-]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
LETTER = r"[a-záéíóúüñA-ZÁÉÍÓÚÜÑ]"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}"
    r"\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}]+"
)
TRUNCATION_MARKERS = ("[truncated]", "<|im_end|", "<|endoftext|")
SEPARATOR = "␟"


def remove_hashes(c: Column) -> Column:
    return F.replace(c, F.lit("#"), F.lit(""))


def remove_images(c: Column) -> Column:
    return F.regexp_replace(c, IMAGE, "")


def collapse_newlines(c: Column) -> Column:
    return F.regexp_replace(c, NEWLINES, "\n")


def headings_to_colon(c: Column) -> Column:
    return F.regexp_replace(c, WIKI_HEADING, "$1:")


def stop_open_lines(c: Column) -> Column:
    """A full stop at a line end without punctuation, where the next line begins with a capital."""
    return F.regexp_replace(c, OPEN_LINE, "$1.\n$2")


CLEANING = {
    "hashes": remove_hashes,
    "images": remove_images,
    "newlines": collapse_newlines,
    "headings": headings_to_colon,
    "open_lines": stop_open_lines,
}


def clean(c: Column, **switches: bool) -> Column:
    """The cleaning chain in its order; each step is on unless switched off by name."""
    unknown = set(switches) - set(CLEANING)
    if unknown:
        raise ValueError(f"unknown cleaning steps: {sorted(unknown)}")
    for name, step in CLEANING.items():
        if switches.get(name, True):
            c = step(c)
    return c


def token_count(c: Column) -> Column:
    """Words and symbols of a text; 0 of a null."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def squeeze(c: Column) -> Column:
    """Runs of white space to one blank, ends trimmed; null to the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def mask_mentions(c: Column, to: str = "@usuario") -> Column:
    return F.regexp_replace(c, MENTION_NAME, to)


def mask_personal(c: Column, email: str = "<EMAIL>", ip: str = "<IP>") -> Column:
    """E-mail addresses and IPv4 addresses replaced."""
    return F.regexp_replace(F.regexp_replace(c, EMAIL, email), IPV4, ip)


def drop_symbol_lines(c: Column, symbol: str) -> Column:
    """Without the lines that hold only a symbol and blanks."""
    kept = F.filter(F.split(c, "\n"), lambda x: ~(F.contains(x, F.lit(symbol)) & (F.trim(F.replace(x, F.lit(symbol), F.lit(""))) == "")))
    return F.array_join(kept, "\n")


def html_by_pattern(c: Column) -> Column:
    """Tags to blanks, line breaks and tabs to blanks, runs of blanks to one; null to the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), "[\r\n\t]+", " "), " +", " ")), F.lit(""))


def drop_references(c: Column) -> Column:
    """Without bracketed reference numbers."""
    return F.regexp_replace(c, r"\[\d+\]", "")


def drop_section(c: Column, title: str) -> Column:
    """Without a wiki section of that title, up to the next heading of its level or the end."""
    return F.regexp_replace(c, rf"(?s)==\s*{title}\s*==.*?(?===[^=]|\z)", "")


def strip_thinking(c: Column) -> Column:
    """Without think blocks, and without their tags where one stands alone."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?is)<think>.*?</think>", ""), r"(?i)</?think>", ""))


def prompt_safe(c: Column) -> Column:
    """Quotes to apostrophes, line breaks to blanks, other control characters out."""
    plain = F.translate(F.translate(c, '"“”«»`', "''''''"), "\r\n\t", "   ")
    return F.regexp_replace(plain, r"[\x{00}-\x{1f}\x{7f}]", "")


def match_key(c: Column) -> Column:
    """Lower case with only letters and digits of Spanish."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9áéíóúüñ]", "")


def reflow(c: Column) -> Column:
    """Line breaks after a full stop kept, others to blanks."""
    kept = F.replace(c, F.lit(".\n"), F.lit(".\t"))
    return F.replace(F.replace(kept, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit("\n"))


def within_budget(c: Column, tokens: int, per_token: float = 3.7) -> Column:
    """The text cut to a budget of characters."""
    return F.substring(c, 1, int(tokens * per_token))


def content_words(c: Column, stop_words: list[str], least: int = 3) -> Column:
    """Lower-case words of ``least`` letters or more that aren't stop words, in order."""
    found = F.regexp_extract_all(F.lower(c), F.lit(rf"(\p{{L}}{{{least},}})"), F.lit(1))
    return F.filter(found, lambda w: ~w.isin(stop_words)) if stop_words else found


def sentences(c: Column, pattern: str = r"(?<=[.?!])\s+") -> Column:
    """Sentences in order, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, pattern), lambda s: F.trim(s)), lambda s: s != "")


def url_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(URL)), F.lit(0))


def mention_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(MENTION)), F.lit(0))


def has_run(c: Column, longest: int) -> Column:
    """Whether a character other than a line break stands more than ``longest`` times in a row."""
    return c.rlike(rf"(.)\1{{{longest},}}")


def symbol_share(c: Column) -> Column:
    """Characters that are neither letters nor blanks, of all; 0 of an empty text."""
    return F.when(F.length(c) > 0, F.regexp_count(c, F.lit(r"[^\p{L}\s]")) / F.length(c)).otherwise(F.lit(0.0))


def only_emoji(c: Column) -> Column:
    """Nothing left without emoji, blanks, punctuation and symbols; false of a blank text."""
    rest = F.regexp_replace(F.regexp_replace(c, EMOJI, ""), r"[\p{Z}\p{P}\p{S}]", "")
    return (F.trim(F.regexp_replace(c, r"\s+", " ")) != "") & (rest == "")


def just_url(c: Column, least: int = 30) -> Column:
    """Fewer than ``least`` characters besides URLs."""
    return F.length(F.trim(F.regexp_replace(c, URL, ""))) < least


def ends_truncated(c: Column) -> Column:
    """Ends with one of the markers that generation leaves where it was cut."""
    out = F.lit(False)
    for marker in TRUNCATION_MARKERS:
        out = out | F.endswith(c, F.lit(marker))
    return out


def hash_parts(*parts: Column) -> Column:
    """SHA-256 of the parts, told apart by a separator no text has."""
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def shuffle_key(key: Column, seed: int | str) -> Column:
    """The same pseudo-random order in any engine: MD5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def hash_number(*parts: Column | str) -> Column:
    """A number of 60 bits from the MD5 of the parts, the same in any engine; null if a part is."""
    joined = F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit("|")] if i else []) + [F.lit(p) if isinstance(p, str) else p.cast("string")]])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def word_grams(c: Column, n: int) -> Column:
    """Runs of n words, in order; none of a shorter text."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    # the words are the element of a list of one, so that they are found once and not again at every run
    def runs(w: Column) -> Column:
        last = F.size(w) - (n - 1)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))

    return F.transform(F.array(found), runs)[0]


# What UTF-8 text read as Latin-1 looks like, and what it was.
MOJIBAKE = {
    "Ã¡": "á", "Ã©": "é", "Ã­": "í", "Ã³": "ó", "Ãº": "ú", "Ã±": "ñ", "Ã¼": "ü", "Ã§": "ç", "Ã¨": "è", "Ã²": "ò",
    "â€œ": "“", "â€™": "’", "â€“": "–", "â€”": "—", "â€¦": "…", "Â¿": "¿", "Â¡": "¡", "Âº": "º", "Âª": "ª", "Â«": "«", "Â»": "»",
}


def repair_encoding(c: Column) -> Column:
    """Common pairs of wrongly read characters put right."""
    for wrong, right in MOJIBAKE.items():
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c
