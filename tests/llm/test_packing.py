from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keyfold.llm import packing, queries
from keyfold.llm.tokens import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return WordIds(PATH, max_words=20)


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aA'sS .\n\x1c\x85éÉİǅΣ<|0")), max_size=40))
def test_ids_are_the_tokenizers_own(text):
    tokenizer, words = Tokenizer.from_file(PATH) if not hasattr(test_ids_are_the_tokenizers_own, "t") else test_ids_are_the_tokenizers_own.t, None
    test_ids_are_the_tokenizers_own.t = tokenizer
    words = getattr(test_ids_are_the_tokenizers_own, "w", None) or WordIds(PATH, max_words=20)
    test_ids_are_the_tokenizers_own.w = words
    assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, got, tokenizer, most_padding):
    ids = defaultdict(list)
    for doc, text in rows:
        ids[doc].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    # pieces of one document, and of one row among equal ids, follow one another
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32))
        windows[r.sequence_id].append((r.offset, r.length, r.context, r.step))
    for doc, several in ids.items():
        expected = []
        for x in several:
            starts = sorted({s for t, s, _, _ in by_doc[doc] if t == len(x)})
            expected += [(len(x), s, min(4096, len(x) - s), zlib.crc32(x[s:s + 4096].tobytes())) for s in starts]
        assert sorted(by_doc[doc]) == sorted(expected)
        assert sum(n for _, _, n, _ in by_doc[doc]) == sum(len(x) for x in several)
    assert sorted(windows) == list(range(len(windows)))
    padded = total = 0
    for pieces in windows.values():
        at = 0
        for offset, length, context, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= pieces[0][2] <= 4096
        padded += 0 if at & (at - 1) == 0 else 4096 - at
        total += at
    assert padded <= most_padding * total


def test_awkward_rows(docs, tokenizer):
    got = packing.pack(docs, PATH).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got, tokenizer, 0.2)


def test_given_table(spark, sample, tokenizer):
    got = queries.QUERIES["op5_packing"](spark, "/root/testdata/sf0.001").collect()
    check([(r.doc_id, r.text) for r in sample.collect()], got, tokenizer, 0.03)


def test_empty(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
def test_plan_places_every_piece_once(counts):
    histogram = np.zeros(65, dtype=np.int64)
    for n, c in counts.items():
        histogram[n] = c
    plan = packing.Plan(histogram, (8, 16, 32, 64))
    numbers = defaultdict(list)
    for n, first, end, *_ in plan.rows():
        numbers[n] += range(first, end)
    assert {n: sorted(x) for n, x in numbers.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    assert all(g.gap >= 0 and g.count > 0 for g in plan.groups)
    assert all(g.gap == 0 for g in plan.groups if g.size < 64)


def test_steps_cost_about_the_same():
    rng = np.random.default_rng(0)
    histogram = np.bincount(np.minimum(rng.geometric(1 / 900, 20_000), 4096), minlength=4097)
    plan = packing.Plan(histogram)
    costs = np.concatenate([[g.cost] * g.count for g in plan.groups if g.size == 4096])
    steps = -(-len(costs) // 64)
    along = np.arange(len(costs)) % steps
    dealt = np.where(np.arange(len(costs)) // steps % 2 == 0, along, steps - 1 - along)
    sums = np.bincount(dealt, weights=costs) / np.bincount(dealt)
    assert sums.max() / sums.min() < 1.15
