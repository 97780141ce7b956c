"""Problem 2: token budget per source, language and domain."""

from __future__ import annotations

import math
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.text import map_rows, source_name, token_count

# Spellings of the languages of the corpus, without diacritics.
LANGUAGES = {
    "es": ["es", "spa", "esp", "espanol", "castellano", "spanish", "castilian", "castella", "espagnol", "espanhol"],
    "en": ["en", "eng", "english", "ingles", "angles", "anglais"],
    "ca": ["ca", "cat", "catala", "catalan", "valencia", "valenciano", "catalao"],
    "pt": ["pt", "por", "portugues", "portuguese", "portugais"],
    "fr": ["fr", "fra", "fre", "francais", "frances", "french"],
}


def language_code(declared: Column) -> Column:
    """Two-letter code of a code, locale or name; null if it is none of the corpus's languages."""
    plain = F.translate(F.lower(F.trim(declared)), "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}_-]", "")
    head = F.regexp_extract(plain, r"^([a-z]+)", 1)
    pairs = [F.lit(x) for code, names in LANGUAGES.items() for name in names for x in (name, code)]
    return F.element_at(F.create_map(*pairs), head)


def declared_language(metadata: Column) -> Column:
    """Code of the language in a JSON text, under lang, idioma or language; ``und`` without one."""
    parsed = F.try_parse_json(metadata)
    found = [language_code(F.try_variant_get(parsed, f"$.{key}", "string")) for key in ("lang", "idioma", "language")]
    return F.coalesce(*found, F.lit("und"))


def registration_date(text: Column) -> Column:
    """D/M/Y, padded or not, or Y-M-D; null otherwise."""
    t = F.trim(text)
    day_first = F.regexp_extract(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 3)
    part = lambda i: F.lpad(F.regexp_extract(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", i), 2, "0")
    turned = F.concat_ws("-", day_first, part(2), part(1))
    return F.try_to_date(F.when(day_first != "", turned).otherwise(t), "y-M-d")


def latest_registration(resources: DataFrame) -> DataFrame:
    """(source_id, domain, tokens_registered) of each source's latest registration.

    Of several on one day, one with a domain comes before one without, then the last in order of name.
    """
    tokens = F.expr("try_cast(regexp_replace(trim(tokens), '[.,]', '') as bigint)")
    domain = F.lower(F.trim("domain"))
    return (
        resources.where(F.col("dataset").isNotNull())
        .select(
            source_name("dataset").alias("source_id"),
            F.struct(
                F.coalesce(registration_date(F.col("reg_date")), F.lit("0001-01-01").cast("date")).alias("d"),
                F.when(domain != "", domain).alias("domain"),
                tokens.alias("tokens_registered"),
            ).alias("r"),
        )
        .groupBy("source_id")
        .agg(F.max("r").alias("r"))
        .select("source_id", "r.domain", "r.tokens_registered")
    )


def documents_once(rows: DataFrame, count: Column) -> DataFrame:
    """(source_id, lang, n_tokens): one row by key (source name, id), of its latest delivery.

    Tokens and language are worked out before the shuffle, so that no text
    goes through it. Rows without an id are told apart by their text.
    """
    key = F.coalesce(F.concat(F.lit("i"), F.col("id")), F.concat(F.lit("t"), F.sha2("text", 256)))
    return (
        rows.select(source_name("source_id").alias("source_id"), key.alias("key"), F.struct(F.col("loaded_at"), count.alias("n_tokens"), declared_language(F.col("metadata")).alias("lang")).alias("r"))
        .groupBy("source_id", "key")
        .agg(F.max("r").alias("r"))
        .select("source_id", "r.lang", "r.n_tokens")
    )


def token_budget(rows: DataFrame, resources: DataFrame, count: Column | None = None) -> DataFrame:
    """(source_id, lang, domain, n_docs, n_tokens, tokens_registered) of the usable texts.

    ``count``: tokens of a row; by default those of the corpus's own token
    pattern in ``text``. Texts without any token, null and blank ones among
    them, don't count; a key delivered again counts once; a source that is
    null is ``unknown`` and has the domain ``unknown``; empty tables give an
    empty result. Other columns are ignored.
    """
    once = documents_once(rows, token_count("text") if count is None else count)
    slices = once.where("n_tokens > 0").groupBy("source_id", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    registered = latest_registration(resources).where("source_id <> 'unknown'")
    return slices.join(registered, "source_id", "left").select(
        "source_id", "lang", F.coalesce("domain", F.lit("unknown")).alias("domain"), "n_docs", "n_tokens", "tokens_registered"
    )


class DoubleArray:
    """Double-array trie over the bytes of a vocabulary, with the score of each entry."""

    def __init__(self, pieces: dict[bytes, float]):
        tree: list[dict[int, int]] = [{}]
        ends: dict[int, float] = {}
        for piece, score in pieces.items():
            at = 0
            for b in piece:
                to = tree[at].get(b)
                if to is None:
                    to = tree[at][b] = len(tree)
                    tree.append({})
                at = to
            ends[at] = score
        used = bytearray(4 * len(tree) + 2048)
        base, check, score = [0] * len(used), [-1] * len(used), [math.nan] * len(used)
        used[0], check[0] = 1, 0
        place = {0: 0}
        start = 1
        queue = [0]
        for node in queue:
            at = place[node]
            if node in ends:
                score[at] = ends[node]
            children = sorted(tree[node])
            if not children:
                continue
            slot, seen = max(start, children[0] + 1), 0
            while True:
                slot = used.find(0, slot)
                if slot < 0 or slot + 256 >= len(used):
                    grow = len(used)
                    used += bytes(grow)
                    base += [0] * grow
                    check += [-1] * grow
                    score += [math.nan] * grow
                    slot = max(slot, 0) or used.find(0, start)
                    continue
                offset = slot - children[0]
                if not any(used[offset + b] for b in children):
                    break
                slot += 1
                seen += 1
            if seen > 64 and not slot > 4 * start + 1024:
                start = slot  # the slots before are nearly full
            base[at] = offset
            for b in children:
                used[offset + b] = 1
                check[offset + b] = at
                place[tree[node][b]] = offset + b
                queue.append(tree[node][b])
        last = max(place.values()) + 257
        self.base, self.check, self.score = ((x + x[-1:] * 257)[:last] for x in (base, check, score))

    def prefixes(self, text: bytes, at: int) -> list[tuple[int, float]]:
        """(end, score) of each entry that begins at a place of the text."""
        base, check, score = self.base, self.check, self.score
        out = []
        node = 0
        for i in range(at, len(text)):
            to = base[node] + text[i]
            if base[node] == 0 or to >= len(check) or check[to] != node:
                break
            node = to
            if score[node] == score[node]:
                out.append((i + 1, score[node]))
        return out


def path_length(trie: DoubleArray, text: bytes, unknown: float = -20.0) -> int:
    """Pieces on the best path through the text; a byte that no entry covers counts as a piece of its own."""
    n = len(text)
    best = [-math.inf] * (n + 1)
    pieces = [0] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        if best[i] == -math.inf:
            continue
        for end, score in [*trie.prefixes(text, i), (i + 1, unknown)]:
            s = best[i] + score
            if s > best[end]:
                best[end], pieces[end] = s, pieces[i] + 1
    return pieces[n]


def unigram_vocabulary(model: bytes) -> dict[bytes, float]:
    """Pieces of a serialised sentencepiece unigram model with their log-probabilities; empty of a model of another kind.

    A model of merges has ranks where a unigram model has log-probabilities:
    whole numbers, one less for each piece.
    """
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = {}
    for i in range(read.get_piece_size()):
        if not (read.is_control(i) or read.is_unknown(i) or read.is_byte(i) or read.is_unused(i)):
            out[read.id_to_piece(i).encode()] = read.get_score(i)
    return {} if all(x == int(x) for x in out.values()) else out


_SEGMENT = re.compile(r"\S+")


class SegmentCounter:
    """Pieces of a normalised segment under an existing vocabulary.

    Of a unigram vocabulary by count-only Viterbi over a double-array trie;
    of one of merges, for which the best path isn't the encoding, by the
    tokenizer's own encoder. Segments met before are remembered, up to
    ``memo`` of them.
    """

    def __init__(self, vocabulary: dict[bytes, float] | None, model: bytes | None, memo: int = 200_000):
        self.trie = DoubleArray(vocabulary) if vocabulary else None
        self.encoder = None
        if not vocabulary:
            import sentencepiece

            self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.memo = memo
        self.known: dict[str, int] = {}

    def count(self, texts: list[str | None]) -> list[int]:
        segments = [_SEGMENT.findall(unicodedata.normalize("NFKC", t)) if t else [] for t in texts]
        new = list({s for found in segments for s in found if s not in self.known})
        if len(self.known) + len(new) > self.memo:
            new = list({s for found in segments for s in found})
            self.known = {}
        if self.trie is not None:
            self.known.update((s, path_length(self.trie, ("▁" + s).encode())) for s in new)
        elif new:
            self.known.update(zip(new, map(len, self.encoder.encode(new))))
        return [sum(map(self.known.__getitem__, found)) for found in segments]


def subword_counts(rows: DataFrame, model_file: str | None = None, *, vocabulary: dict[bytes, float] | None = None, text_column: str = "text") -> DataFrame:
    """``rows`` with ``n_subwords``: pieces of each text under an existing tokenizer.

    ``model_file`` is a sentencepiece model; ``vocabulary`` gives pieces and
    log-probabilities of a unigram tokenizer instead. Texts are normalised
    (NFKC) and cut at white space. Null and empty texts have 0.
    """
    model = None
    if vocabulary is None:
        with open(model_file, "rb") as f:
            model = f.read()
        vocabulary = unigram_vocabulary(model)
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, model))
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", n_subwords bigint"
    built: list[SegmentCounter] = []

    def count(batch: dict[str, list]) -> dict[str, list]:
        if not built:
            built.append(SegmentCounter(*shared.value))
        return {**{c: batch[c] for c in names}, "n_subwords": built[0].count(batch[text_column])}

    return map_rows(rows, count, schema)
