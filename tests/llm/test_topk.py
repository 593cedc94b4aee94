from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import topk
from keyfold.llm.common import workers_find_package


def brute(rows, k=5):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(df, **options):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, **options).collect())


ROWS = [(0, [1.0, -0.5, 0.25]), (50, [0.0, 0.0, 0.0]), (1, None), (2, [None, 1.0, 1.0]), (3, [float("nan"), 0.0, 0.0]), (4, [float("inf"), 0.0, 0.0]),
        (100, [float("-inf"), 0.0, 0.0]), (5, [1.0, -0.5, 0.25]), (6, [1.0, -0.5, 0.25]), (7, [-1.0]), (8, []), (9, [0.1, 0.1, 0.1, 9.0]),
        (150, [-0.001, 0.999, 0.5]), (10, [3.0, 3.0, 3.0]), (11, [3.0, 3.0, 3.0]), (None, [9.0, 9.0, 9.0])]


@pytest.mark.parametrize("block", [2, 1000])
def test_awkward_rows(spark, block):
    workers_find_package(spark)
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in ROWS], "vec_id long, embedding array<float>, label int, score string")
    assert search(df, block=block) == brute(ROWS)
    assert search(df.where("vec_id = 0")) == []
    assert search(df.where("false")) == []


def test_given_table(spark):
    workers_find_package(spark)
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert search(df, block=64) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_large_values_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 0.0]), (2, [3e6, 0.0625]), (3, [-3e6, 5.0])]
    assert search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")) == brute(rows)


def test_stops_early_on_peaked_lists():
    """With a few large components, the bound ends the walk before all vectors are met."""
    rng = np.random.default_rng(0)
    vectors = rng.integers(-3, 4, (4000, 8)).astype(float)
    vectors[:20, 0] = 1000 + np.arange(20)
    lists = topk.SortedLists(np.arange(4000), vectors)
    seen = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    lists.vectors = vectors.view(Counting)
    ids, scores = lists.top(-1, np.array([50.0, 1, 0, 0, 0, 0, 0, 0]), 5)
    full = vectors @ np.array([50.0, 1, 0, 0, 0, 0, 0, 0])
    assert list(ids) == sorted(range(4000), key=lambda i: (-full[i], i))[:5]
    assert sum(seen) < 400
