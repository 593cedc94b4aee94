"""Decontamination against a search of every window in every document."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from keyfold.llm import fm_index
from keyfold.llm.common import workers_find_package

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower()) if (text or "").isascii() else WORD.findall(
        re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain(docs, items, window=10):
    """doc rows -> (doc_id, n_words, hit words, item names)"""
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).update([] if item is None else [str(item)])
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names is not None:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), hit, sorted(found)))
    return out


def digest(rows):
    return sorted(((d, n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h)) for d, n, h, i in rows), key=str)


def both(spark, docs, items, **options):
    workers_find_package(spark)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, row int").repartition(3)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    return table, asked, sorted((tuple(r) for r in fm_index.contamination(table, asked, **options).collect()), key=str)


def babble(rng, n, words="a b c d e f g h".split()):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("shard_words", [fm_index.SHARD_WORDS, 150])
def test_equals_plain_search(spark, shard_words):
    rng = random.Random(3)
    passage = babble(rng, 30)
    docs = [(i, babble(rng, rng.choice([0, 3, 50, 700])) + (" " + passage.upper() + "!" if i % 3 == 0 else "")) for i in range(40)]
    items = [(1, passage), (2, "a b a"), (10, passage[4:60]), (3, babble(rng, 14)), (4, "zzz yyy"), (5, "c"), (10, "h g")]
    _, _, got = both(spark, docs, items, shard_words=shard_words)
    assert got == digest(plain(docs, items)) and sum(r[2] for r in got)


def test_awkward_rows(spark):
    base = " ".join(f"w{i}" for i in range(25))
    docs = [(1, base), (1, base), (2, None), (3, ""), (None, "Né\0" + base), (4, " \t.,;"), (5, "x" * 5000), (6, base.replace(" ", "--")),
            (7, "äÖ日本 A1 é"), (8, " ".join(f"t{i % 977}" for i in range(30000)) + " " + base)]
    items = [(1, base), (None, "w3 w4"), (2, None), (3, "..."), (11, "äÖ日本 a1"), (5, "w24"), (5, "w24")]
    table, asked, got = both(spark, docs, items)
    assert got == digest(plain(docs, items))
    for no_docs, no_items in ((True, False), (False, True), (True, True)):
        out = fm_index.contamination(table.limit(0) if no_docs else table, asked.limit(0) if no_items else asked)
        assert [r.n_hit for r in out.collect()] == ([] if no_docs else [0] * len(docs))


def test_phrases_in_several_rounds(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, babble(rng, 200)) for i in range(12)]
    items = [(i, babble(rng, 6)) for i in range(60)]
    monkeypatch.setattr(fm_index, "ROUND_BYTES", 300)
    _, _, got = both(spark, docs, items)
    assert got == digest(plain(docs, items))


def test_cut_texts_keep_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(1, f"before, {passage}! after"), (2, "nothing"), (3, None), (4, passage), (5, f"{passage} and {passage}."), (1, f"before, {passage}! after")]
    table, asked, _ = both(spark, docs, [(1, passage)])
    got = sorted((r.doc_id, r.text) for r in fm_index.without_hits(table, asked).collect() if r.text is not None)
    assert got == [(1, "before, ! after")] * 2 + [(2, "nothing"), (4, ""), (5, " and .")]
    assert fm_index.without_hits(table, asked).columns == table.columns


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(1)
    sizes = np.array([40, 0, 300, 1, 40])
    words = rng.integers(0, 3, sizes.sum()).astype(np.uint64) * np.uint64(1 << 50)
    words[341:381] = words[:40]  # a copy
    index = fm_index.FMIndex.of(fm_index.FMIndex.build(words, sizes).columns())
    text, at = [], 0
    for size in sizes:
        text += [*(words[at:at + size].tolist()), -1]
        at += size
    for n in (1, 2, 3, 7):
        for start in range(len(words) - n):
            phrase = words[start:start + n]
            symbols = index.symbols_of(phrase)
            which, low, high = index.ranges(np.array([n]), np.array([n]), symbols)
            want = [i for i in range(len(text)) if text[i:i + n] == phrase.tolist()]
            got = sorted(index.locate(np.arange(low[0], high[0])).tolist()) if len(which) else []
            assert got == want


def test_longer_windows_are_refused(spark, no_docs):
    with pytest.raises(ValueError, match="words"):
        fm_index.find(no_docs, no_docs, window=fm_index.LONGEST + 1)
