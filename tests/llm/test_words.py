from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from keyfold.llm.words import shingle_sets, word_hashes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=8))
def test_words_are_what_split_gives(texts):
    hashes, counts = word_hashes(texts)
    words = [t.lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len({*flat}) == len({*hashes.tolist()})
    assert len({*zip(flat, hashes.tolist())}) == len({*flat})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n", max_size=30).map(str.encode), max_size=6))
def test_shingle_sets_have_the_size_of_the_real_sets(texts):
    seen: dict = {}
    for text, got in zip(texts, shingle_sets(texts, 3)):
        w = text.split()
        real = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
        assert len(got) == len(real) and (np.diff(got.astype(object)) > 0).all()
        assert seen.setdefault(frozenset(real), got.tobytes()) == got.tobytes()
