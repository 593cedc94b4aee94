from __future__ import annotations

import hashlib

import numpy as np
import pytest

from keyfold.llm import minhash


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    order = sorted(((i if i is not None else -(1 << 63)), (t or "")) for i, t in rows)
    order.sort(key=lambda r: r[1])
    order.sort(key=lambda r: -r[0])
    by: dict = {}
    for r in got:
        by.setdefault((r.doc_id if r.doc_id is not None else -(1 << 63), r.n_chars, r.edited_sha256), []).append(r)
    prints: dict = {}
    errors = []
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        r = by[key, len(text), hashlib.sha256(changed.encode()).hexdigest()].pop()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
        errors += [r.near_edited - jaccard(shingles(text), shingles(changed)), r.near_next - jaccard(shingles(text), shingles(following))]
    assert not any(by.values())
    assert np.abs(errors).max() < 0.16 and np.abs(errors).mean() < 0.05


def test_followers_on_awkward_rows(docs):
    check([(r.doc_id, r.text) for r in docs.collect()], minhash.with_followers(docs).collect())


def test_followers_on_given_table(sample):
    check([(r.doc_id, r.text) for r in sample.collect()], minhash.with_followers(sample).collect())


def test_single_and_empty(docs, no_docs):
    assert minhash.with_followers(no_docs).count() == 0
    (one,) = minhash.with_followers(docs.where("doc_id = 1")).collect()
    assert one.near_next == 1.0


def test_near_duplicates(docs, no_docs):
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=str)
    expected = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
    assert got == sorted(((r.doc_id, expected.get(r.doc_id, r.doc_id)) if r.doc_id is not None or not r.text.endswith("x59") else (None, 1)
                          for r in docs.collect()), key=str)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_signature_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    for keep in (0, 300, 800, 1000):
        b = np.concatenate([a[:keep], rng.integers(0, 1 << 63, 1000 - keep).astype(np.uint64)])
        assert minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b)) == pytest.approx(keep / (2000 - keep), abs=0.12)


def linked(monkeypatch, spark, sets, buckets, **kw):
    """near_duplicates over given shingle sets and their buckets: {doc: component}."""
    rows = [(i, f"c{i:05}".encode(), len(s), sorted(s), b) for i, (s, b) in enumerate(zip(sets, buckets))]
    monkeypatch.setattr(minhash, "banded", lambda *_, **__: spark.createDataFrame(
        rows, "doc_id long, cls binary, n long, h array<long>, bands array<long>"))
    return {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.range(0), **kw).collect()}


@pytest.mark.parametrize("most", [0, 8])
def test_a_chain_in_one_bucket_is_one_component(spark, monkeypatch, most):
    """Each links to the next one only, whichever of them is the hub."""
    monkeypatch.setattr(minhash, "MOST_PAIRS", most)
    chain = [set(range(i, i + 10)) for i in range(8)]
    assert set(linked(monkeypatch, spark, chain, [[1]] * 8).values()) == {0}


def test_a_bucket_of_unlike_classes_is_compared_to_the_end(spark, monkeypatch):
    """More classes that aren't alike than there are rounds: the one pair that links is found."""
    monkeypatch.setattr(minhash, "MOST_PAIRS", 0)
    sets = [{100 * i + k for k in range(10)} for i in range(40)] + [{k for k in range(9)}]
    got = linked(monkeypatch, spark, sets, [[1]] * 41, hub_rounds=2)
    assert got == {i: i for i in range(40)} | {40: 0}
