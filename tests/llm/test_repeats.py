from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyfold.llm import repeats
from keyfold.llm.common import workers_return_memory

LAST = (1 << 63) - 1


def brute(rows, n=50):
    """Spans by looking up every window."""
    order = sorted(((LAST if i is None else i, i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0], r[2]))
    first: dict = {}
    for key, _, data in order:
        for at in range(len(data) - n + 1):
            first.setdefault(data[at:at + n], key)
    out = []
    for key, doc, data in order:
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - n + 1):
            if first[data[at:at + n]] < key:
                gone[at:at + n] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    return sorted((tuple(r) for r in repeats.remove_repeats(df, **options).collect()), key=str)


def test_awkward_rows(docs):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_given_table(sample):
    assert got(sample) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_empty(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_repetitive_texts(spark, letters):
    """Passages inside one another, at both ends, overlapping, and of one letter only."""
    rng = random.Random(len(letters))
    parts = ["".join(rng.choice(letters) for _ in range(rng.randint(20, 90))) for _ in range(8)] + ["a" * 70, "ab" * 40, "é" * 30]
    rows = [(rng.randint(0, 30), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == brute(rows)


def test_cut_texts(docs):
    out = {(r.doc_id, r.text) for r in repeats.without_repeats(docs).collect()}
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert {(4, None), (5, ""), (7, "one two")} <= out
    assert not any(doc == 2 for doc, _ in out)  # a whole copy goes
    assert next(t for d, t in out if d == 1) == next(t for d, t in texts if d == 1)
    assert len(next(t for d, t in out if d == 14)) < len(next(t for d, t in texts if d == 14))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25))
def test_intervals_of_a_prefix_array(lcp):
    lcp[0] = 0
    found = set(repeats.intervals(lcp, 1))
    expected = set()
    for size in range(1, 7):
        at = 0
        while at < len(lcp):
            end = at + 1
            while end < len(lcp) and lcp[end] >= size:
                end += 1
            if end - at > 1 and min(lcp[at + 1:end]) == size:
                expected.add((at, end, size))
            at = end
    assert found == expected


@settings(max_examples=50, deadline=None)
@given(st.text("ab", min_size=60, max_size=200).map(str.encode), st.binary(max_size=20), st.binary(max_size=20))
def test_equal_windows_have_equal_anchors(passage, before, after):
    inside = lambda text, at: {(p - at, h) for p, h in zip(*(x.tolist() for x in repeats.anchors(text, 50)))}
    alone, around = inside(passage, 0), inside(before + passage + after, len(before))
    for at in range(len(passage) - 49):
        mine = lambda found, at=at: {x for x in found if at <= x[0] <= at + 30}
        assert mine(alone) & mine(around)


def test_a_shard_is_sorted_without_copies_of_itself():
    """Sorting suffixes and comparing neighbours takes little besides the suffixes and what lies to their left."""
    rng = np.random.default_rng(5)
    n = 100_000
    right, left = rng.integers(97, 123, (n, 50)).astype(np.uint8), rng.integers(97, 123, (n, 30)).astype(np.uint8)
    tracemalloc.start()
    shard = repeats.Shard(right, np.full(n, 50), left, np.full(n, 30), 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = [right[i].tobytes() for i in shard.order]
    assert rows == sorted(rows)
    assert peak < 150 * n


def test_workers_give_freed_memory_back(spark, docs):
    """A worker that has freed large arrays is as small as before."""

    def held(parts):
        resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
        for _ in parts:
            before = resident()
            np.ones(8 << 20, np.uint8)  # raises the size from which malloc maps, unless that is fixed
            for _ in range(3):
                arrays = [np.ones(2 << 20, np.uint8) for _ in range(40)]
                last = np.ones(1 << 18, np.uint8)
                del arrays
            yield pa.RecordBatch.from_pydict({"kept": [resident() - before - len(last)]}, schema=pa.schema([("kept", pa.int64())]))

    workers_return_memory(spark)
    kept = docs.limit(1).mapInArrow(held, "kept long").agg(F.max("kept")).first()[0]
    assert kept < 16 << 20
