"""Problem 7: evaluation passages leaking into training text.

A generalised suffix automaton is built over the words of all passages. The
words of each document stream through it; the length of the longest match at
each word is kept, and where it reaches ``min_words`` the passages holding
those words are known from the state, without comparing any two texts.

A document without any run of ``min_words`` words that some passage has can't
match. A bitmap of those runs, of one size for any number of passages, lets
only the others through to the automata, and passages go to the workers in
blocks of a bounded size, where each block's automaton is built.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.llm.features import hashed_runs
from acequia.llm.text import WORD, fold, map_rows
from acequia.session import materialize

#: Characters of passages in one block, more or less (they are dealt by hash), or one longer passage. Each block's texts are sent to the workers.
BLOCK_CHARS = 4_000_000
#: Bits of the map of runs of words: 8 MB for any number of passages.
MAP_BITS = 26
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-\u2010\u2011\u00ad][ \t]*(?:\r\n|\r|\n|\u2028)\s*(?=[^\W\d_])")
_SPAN = re.compile(r"[^\W_](?:[^\W_]|[\u0300-\u036f\u00ad]|(?<=[^\W\d_])[-\u2010\u2011][ \t]*(?:\r\n|\r|\n|\u2028)\s*(?=[^\W\d_]))*")


def _joined(text: str | None) -> str:
    """Words divided at line ends put together."""
    if not text:
        return ""
    if "\u00ad" in text:
        text = re.sub(r"\u00ad(?=[^\W_])", "", text)
    return _HYPHEN.sub("", text)


def passage_words(text: str | None) -> list[str]:
    """Folded words; a word divided by a hyphen at a line end is one word."""
    return WORD.findall(fold(_joined(text)))


def located_words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words as ``passage_words`` has them, and the place of each in the text, from one pass."""
    found: list[str] = []
    places: list[tuple[int, int]] = []
    for m in _SPAN.finditer(text):
        mine = passage_words(m.group())
        found += mine
        places += [m.span()] * len(mine)
    return found, places


def needed(words: int, min_words: int, short: int | None) -> int:
    """Words in a row by which a passage of so many is met; 0 if it can't be."""
    return min_words if words >= min_words else words if short and words >= short else 0


class PassageAutomaton:
    """Generalised suffix automaton over words, with the passages of each state.

    A passage is met by ``min_words`` of its words in a row; one that has
    fewer, but ``short`` at least, by all of them.
    """

    def __init__(self, passages: list[list[str]], min_words: int, short: int | None = None):
        self.need = [needed(len(p), min_words, short) for p in passages]
        self.min_words = min([n for n in self.need if n], default=min_words)
        self.vocabulary: dict[str, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        rows = []
        for words in passages:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            rows.append(ids)
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self._own(rows)

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p != -1:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w: int) -> int:
        step, link = self.step, self.link
        copy = len(step)
        step.append(dict(step[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and step[p].get(w) == q:
            step[p][w] = copy
            p = link[p]
        return copy

    def _own(self, rows: list[list[int]]) -> None:
        """For each state that stands for min_words words or more, the passages that hold them."""
        own: dict[int, set[int]] = {}
        for k, ids in enumerate(rows):
            if not self.need[k]:
                continue
            at = 0
            for w in ids:
                at = self.step[at][w]
                s = at
                while self.length[s] >= self.min_words and k not in own.setdefault(s, set()):
                    own[s].add(k)
                    s = self.link[s]
        self.passages = {s: tuple(x) for s, x in own.items()}

    def matches(self, words: list[str]) -> tuple[dict[int, int], list[tuple[int, int]]]:
        """Longest match in words by passage; spans [from, to) of words that lie in matches."""
        step, link, length, least, need = self.step, self.link, self.length, self.min_words, self.need
        get = self.vocabulary.get
        state = n = 0
        best: dict[int, int] = {}
        spans: list[tuple[int, int]] = []
        for i, word in enumerate(words):
            w = get(word)
            if w is None:
                state = n = 0
                continue
            while state and w not in step[state]:
                state = link[state]
                n = length[state]
            to = step[state].get(w)
            if to is None:
                n = 0
                continue
            state = to
            n += 1
            if n >= least:
                s, at, longest = state, n, 0
                while True:
                    for k in self.passages.get(s, ()):
                        if at >= need[k]:
                            longest = max(longest, at)
                            if best.get(k, 0) < at:
                                best[k] = at
                    s = link[s]
                    if length[s] < least:
                        break
                    at = length[s]
                if longest:
                    begin = i + 1 - longest
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, i + 1))
        return best, spans


def _run_map(passages: DataFrame, width: int) -> bytes:
    """Bitmap of the hashes of every run of ``width`` words of the passages, put together in the cluster."""

    def runs(batch: dict[str, list]) -> dict[str, list]:
        h, _ = hashed_runs([_joined(t) for t in batch["passage"]], width)
        at = np.unique(h >> np.uint64(64 - MAP_BITS)).astype(np.int64)
        return {"word": (at >> 6).tolist(), "bit": (at & 63).tolist()}

    spots = map_rows(passages.select("passage"), runs, "word int, bit int")
    words = spots.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.tobytes()


def _candidates(documents: DataFrame, id_column: str, text_column: str, passages: DataFrame, width: int) -> DataFrame:
    """(id, h, text) of the documents that have a run of words of some passage, and a few others; h is a hash of the text."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(_run_map(passages, width))
    id_type = documents.schema[id_column].dataType.simpleString()
    docs = documents.where(F.col(text_column).isNotNull()).select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h"), F.col(text_column).alias("text"))

    def sift(batch: dict[str, list]) -> dict[str, list]:
        table = np.frombuffer(shared.value, dtype=np.uint64)
        h, row = hashed_runs([_joined(t) for t in batch["text"]], width)
        at = h >> np.uint64(64 - MAP_BITS)
        hit = (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        some = np.unique(row[hit == 1]).tolist()
        return {k: [batch[k][i] for i in some] for k in ("id", "h", "text")}

    return map_rows(docs, sift, f"id {id_type}, h bigint, text string")


def _passages(items: DataFrame, passage_column: str) -> tuple[DataFrame, int]:
    """(p, passage, block) of the different passages, p their hash, and the number of blocks."""
    there = items.where(F.length(F.trim(passage_column)) > 0)
    once = there.groupBy(F.sha2(passage_column, 256).alias("p")).agg(F.first(passage_column).alias("passage"))
    once = materialize(once, "passages")
    chars = once.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    return once.withColumn("block", F.pmod(F.xxhash64("p"), F.lit(blocks))), blocks


#: In a worker, the automaton of the block it is at.
_built: dict[str, tuple[list[str], list[int], PassageAutomaton]] = {}


def _block_automata(spark: SparkSession, passages: DataFrame, blocks: int, min_words: int, short: int | None):
    """Of each block: the hashes of its passages, their lengths, and its automaton, as a function to be called in a worker, which builds it once."""
    for block in range(blocks):
        rows = passages.where(F.col("block") == block).select("p", "passage").orderBy("p").toArrow().to_pydict()  # BLOCK_CHARS or so
        shared = spark.sparkContext.broadcast((rows["p"], rows["passage"]))

        def automaton(shared=shared, key=uuid.uuid4().hex) -> tuple[list[str], list[int], PassageAutomaton]:
            if key not in _built:
                split = [passage_words(t) for t in shared.value[1]]
                _built.clear()
                _built[key] = (shared.value[0], [len(w) for w in split], PassageAutomaton(split, min_words, short))
            return _built[key]

        yield automaton


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    passage_column: str = "passage",
    min_words: int = 12,
) -> DataFrame:
    """Each document and item of which the document holds ``min_words`` consecutive words.

    Returns (doc_id, item_id, n_words, coverage): the longest match in words
    and its share of the passage. Every item with that passage counts. Null
    and empty texts and passages, and passages of fewer words, match nothing;
    equal rows give equal results once; empty tables give an empty result;
    other columns of either table are ignored.

    The corpus is read once; of it only what passes the map of runs meets the
    automata, one by block of passages.
    """
    spark = documents.sparkSession
    passages, blocks = _passages(items, passage_column)
    found_in = _candidates(documents, id_column, text_column, passages, min_words)
    if blocks > 1:
        found_in = materialize(found_in, "leak-candidates")
    id_type = documents.schema[id_column].dataType.simpleString()
    found = None
    for block in _block_automata(spark, passages, blocks, min_words, None):

        def scan(rows: dict[str, list], block=block) -> dict[str, list]:
            hashes, sizes, automaton = block()
            out: dict[str, list] = {"id": [], "p": [], "n_words": [], "coverage": []}
            for doc, text in zip(rows["id"], rows["text"]):
                for k, n in automaton.matches(passage_words(text))[0].items():
                    out["id"].append(doc)
                    out["p"].append(hashes[k])
                    out["n_words"].append(n)
                    out["coverage"].append(n / sizes[k])
            return out

        part = map_rows(found_in.select("id", "text"), scan, f"id {id_type}, p string, n_words int, coverage double")
        found = part if found is None else found.unionByName(part)
    holders = items.select(F.sha2(passage_column, 256).alias("p"), F.col(item_column)).distinct()
    return (
        found.groupBy("id", "p")
        .agg(F.max("n_words").alias("n_words"), F.max("coverage").alias("coverage"))
        .join(holders, "p")
        .groupBy(F.col("id").alias(id_column), item_column)
        .agg(F.max("n_words").alias("n_words"), F.max("coverage").alias("coverage"))
    )


def remove_leaks(
    documents: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    passage_column: str = "passage",
    min_words: int = 12,
    short_words: int = 6,
    max_share: float = 0.5,
) -> DataFrame:
    """(doc_id, clean_text, n_removed, share): each document without its leaked spans.

    Spans of ``min_words`` words or more that a passage has are removed, and
    such as are the whole of a shorter passage of ``short_words`` at least.
    The spans of all blocks are found in the document as it is, put together
    and cut out at once, so blocks don't change the result. A document more
    than ``max_share`` of whose words are leaked gets a null ``clean_text``:
    it is to be dropped. Null texts stay null, with 0 removed; repeated rows
    are repeated; without passages all texts stay as they are.
    """
    spark = documents.sparkSession
    passages, blocks = _passages(items, passage_column)

    def sizes(batch: dict[str, list]) -> dict[str, list]:
        return {"n": [needed(len(passage_words(t)), min_words, short_words) for t in batch["passage"]]}

    width = map_rows(passages.select("passage"), sizes, "n int").where("n > 0").agg(F.min("n")).first()[0] or min_words
    found_in = materialize(_candidates(documents, id_column, text_column, passages, width), "leak-candidates")
    id_type = documents.schema[id_column].dataType.simpleString()
    spans = None
    for block in _block_automata(spark, passages, blocks, min_words, short_words):

        def scan(rows: dict[str, list], block=block) -> dict[str, list]:
            automaton = block()[2]
            out: dict[str, list] = {"id": [], "h": [], "spans": []}
            for doc, h, text in zip(rows["id"], rows["h"], rows["text"]):
                found = automaton.matches(located_words(text)[0])[1]
                if found:
                    out["id"].append(doc)
                    out["h"].append(h)
                    out["spans"].append([{"a": a, "b": b} for a, b in found])
            return out

        part = map_rows(found_in, scan, f"id {id_type}, h bigint, spans array<struct<a: int, b: int>>")
        spans = part if spans is None else spans.unionByName(part)
    spans = spans.groupBy("id", "h").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    once = found_in.groupBy("id", "h").agg(F.first("text").alias("text"))
    hit = once.join(spans.withColumnRenamed("id", "i"), (F.col("id").eqNullSafe(F.col("i"))) & (once["h"] == spans["h"])).select("id", once["h"], "text", "spans")

    def cut(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"id": rows["id"], "h": rows["h"], "clean": [], "n": [], "part": []}
        for text, spans in zip(rows["text"], rows["spans"]):
            places = located_words(text)[1]
            inside = np.zeros(len(places), dtype=bool)
            for x in spans:
                inside[x["a"] : x["b"]] = True
            n = int(inside.sum())
            turn = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
            clean = text
            for a, b in reversed(list(zip(turn[::2].tolist(), turn[1::2].tolist()))):
                clean = clean[: places[a][0]] + clean[places[b - 1][1] :]
            out["clean"].append(clean if n <= max_share * len(places) else None)
            out["n"].append(n)
            out["part"].append(n / len(places))
        return out

    cleaned = map_rows(hit, cut, f"id {id_type}, h bigint, clean string, n int, part double").withColumnsRenamed({"id": "i", "h": "k"})
    text = F.col(text_column)
    return documents.select(F.col(id_column), text.alias("__text")).join(cleaned, F.col(id_column).eqNullSafe(F.col("i")) & (F.xxhash64("__text") == F.col("k")), "left").select(
        id_column,
        F.when(F.col("n").isNull(), F.col("__text")).otherwise(F.col("clean")).alias("clean_text"),
        F.coalesce("n", F.lit(0)).alias("n_removed"),
        F.coalesce("part", F.lit(0.0)).alias("share"),
    )
