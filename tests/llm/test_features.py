from __future__ import annotations

import random

from acequia.llm import features
from acequia.llm.text import words


def agree(texts):
    h, n = features.word_hashes(texts)
    found = [words(t) for t in texts]
    assert n.tolist() == [len(w) for w in found]
    flat = [w for ws in found for w in ws]
    by_word, by_hash = dict(zip(flat, h.tolist())), dict(zip(h.tolist(), flat))
    assert [by_word[w] for w in flat] == h.tolist() and [by_hash[x] for x in h.tolist()] == flat


def test_hashes_follow_words():
    agree([])
    agree(["Canción áb ́ x_y Ñandú", "", None, "ΟΔΟΣ οδος 한국어 日本語 ǅ İstanbul ﬁn Å", "...", "́", "a", "½ x² Ⅷ ß ẞ \U0001f600 \U0001d400b", "abc cba", "canción"])
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(32, 0x600), *range(0x1E00, 0x2200), 0x3042, 0xAC00, 0x1F600, 0x301, 0x308, 10, 13]]
    agree(["".join(rng.choice(pool) if rng.random() < 0.3 else rng.choice("abcé ñ") for _ in range(rng.randrange(60))) for _ in range(2000)])


def test_one_hash_a_word_in_any_part(monkeypatch):
    texts = [f"palabra{i} común" for i in range(50)]
    whole = features.word_hashes(texts)[0].tolist()
    monkeypatch.setattr(features, "_PART", 30)
    assert features.word_hashes(texts)[0].tolist() == whole
