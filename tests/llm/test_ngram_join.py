from __future__ import annotations

import random
from collections import defaultdict

import pytest

from keyfold.llm import ngram_join


def brute(rows, n=5):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None and (least.get(r) is None or doc < least[r]):
            least[r] = doc
    return sorted(((doc, len(sets[i]), (least.get(root(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows)), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in ngram_join.near_duplicates(df, **options).collect()), key=str)


def test_awkward_rows(docs):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_given_table(sample):
    assert got(sample) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_empty(no_docs):
    assert ngram_join.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("rounds", [0, 12])
def test_families_with_differing_members(spark, rounds, monkeypatch):
    """Near copies of near copies, which link in chains only, among passages that many share."""
    rng = random.Random(7)
    rows = []
    passage = [f"p{i}" for i in range(25)]
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(50)]
        for member in range(12):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(50)] = f"n{rng.randrange(10 ** 6)}"
            rows.append((len(rows) * 3 % 71, " ".join(words + (passage if member % 3 else []))))
    rows += [(100 + i, " ".join(passage + [f"q{i}x{k}" for k in range(4)])) for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # go through hub rounds even though there are few pairs
    monkeypatch.setattr(ngram_join.component_labels, "__defaults__", (0,))
    assert got(df, hub_rounds=rounds) == brute(rows)


def test_pairs_that_meet_too_rarely_are_not_checked(spark, monkeypatch):
    """Texts that share a passage with many others, too little for a link, come to no exact check; those that link do."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows, checked = [], []
    for i in range(40):
        words = passage + [f"w{i}x{k}" for k in range(8)]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join([*words, "end"]))]
    rows += [(500 + i, " ".join(rng.sample(passage, 30))) for i in range(5)]
    overlaps = ngram_join.overlaps
    monkeypatch.setattr(ngram_join, "overlaps", lambda pairs, segments: checked.extend(pairs.collect()) or overlaps(pairs, segments))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, hub_rounds=0) == brute(rows)
    assert len(checked) == 40
