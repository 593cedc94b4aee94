"""Clustering against plain Lloyd's rounds in integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from keyfold.llm import centroids
from keyfold.llm.common import workers_find_package

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, shard string"


def plain(rows, k, rounds, width):
    """(vec_id, cluster, distance) by scanning everything in each round."""
    whole = [(i, [max(-(1 << 26), min(1 << 26, math.floor(1024.0 * float(np.float32(x))))) for x in v]) for i, v in rows
             if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[0], r[1])
    middle = [v for _, v in sorted((r for r in whole if r[0] is not None), key=key)[:k]]
    for turn in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in middle] for _, v in whole]
        best = [f.index(min(f)) for f in far]
        if turn < rounds:
            for c in range(len(middle)):
                mine = [v for (_, v), b in zip(whole, best) if b == c]
                if mine:
                    middle[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i, b, f[b]) for (i, _), b, f in zip(whole, best, far)), key=str), middle


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1, 1]) * (i % 3) + rng.gauss(0, 0.3) for _ in range(width)]) for i in range(n)]


def table(spark, rows):
    workers_find_package(spark)
    return spark.createDataFrame([(i, v, 0, 5, "x") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("k", [1, 2, 8])
def test_equals_plain_rounds(spark, k):
    rows = vectors(300, 6)
    fitted = centroids.fit(table(spark, rows), k=k, width=6, rounds=6)
    want, middle = plain(rows, k, 6, 6)
    assert fitted.centroids.tolist() == middle
    assert sorted((tuple(r) for r in fitted.assigned.collect()), key=str) == want


def test_awkward_vectors(spark):
    rows = vectors(60, 6) + [(None, [0.5] * 6), (7, [0.25] * 6), (7, [0.25] * 6), (100, None), (101, []), (102, [1.0] * 5),
                             (103, [None] + [1.0] * 5), (104, [float("nan")] * 6), (105, [float("inf")] * 6), (106, [3e38] * 6), (107, [-3e38] * 6)]
    rows += [(i, [0.125] * 6) for i in range(200, 230)]  # equal vectors
    want, middle = plain(rows, 4, 5, 6)
    got = centroids.cluster(table(spark, rows), k=4, width=6, rounds=5).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    total = sum(d for _, _, d in want)
    assert {r.inertia for r in got} == {total if total < 1 << 63 else None}
    for r in got:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = vectors(3, 6)
    assert len(centroids.fit(table(spark, rows), k=8, width=6).centroids) == 3
    empty = centroids.cluster(table(spark, []), k=8, width=6)
    assert empty.count() == 0 and "centroid_sha256" in empty.columns


def test_heaps_spare_most_scans(spark):
    """Well-parted groups: after the first rounds hardly any gap expires."""
    rng = random.Random(5)
    rows = [(i, [10.0 * (i % 4) + rng.gauss(0, 0.1) for _ in range(6)]) for i in range(2000)]
    scanned = centroids.fit(table(spark, rows), k=4, width=6, rounds=8).scanned
    assert scanned[0] == 2000 and sum(scanned[4:]) < 2000 * len(scanned[4:]) / 10


def test_heap_order_survives_storage():
    rng = random.Random(2)
    heaps = centroids.Heaps([[], []])
    heaps.push(np.arange(50), np.array([i % 2 for i in range(50)]), np.array([rng.random() for _ in range(50)]))
    again = centroids.Heaps.of(*[heaps.columns()[c] for c in ("sizes", "keys", "rows")])
    rows, owner = again.expired(np.array([0.5, 0.25]))
    want = {(row, c) for c, heap in enumerate(heaps.heaps) for key, row in heap if key <= (0.5, 0.25)[c]}
    assert set(zip(rows.tolist(), owner.tolist())) == want
