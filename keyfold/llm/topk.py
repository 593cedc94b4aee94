"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks by a hash of their id. Each block keeps, for
every dimension, its vectors sorted by that component. A query walks all lists
side by side from the end that its component favours; every vector met is
scored in full. Once the kth best score exceeds the bound (the score that the
components at the present depth would give together), no unseen vector of the
block can enter the result, not even by a tie. The blocks' winners, k per query
and block, meet in one last ranking.

Queries meet candidates block by block (``block`` of each), so a task holds a
bounded number of either.

Cases: a vector that is null or holds null, NaN or infinite components takes no
part, as query or as candidate; shorter vectors count as filled up with zeros;
rows of null id take no part; repeated ids are separate candidates, and a query
skips all rows with its own id; ties go to the smaller id; with fewer
candidates than k, all are returned; an empty table gives an empty result;
other columns are ignored. Scores must fit 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class SortedLists:
    """A block of integer vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        order = np.argsort(self.vectors, axis=0, kind="stable")
        self.ascending, self.descending = np.ascontiguousarray(order.T), np.ascontiguousarray(order.T[:, ::-1])

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, apart from rows with id ``own``."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        weights = query[dims]
        lists = np.where((weights > 0)[:, None], self.descending[dims], self.ascending[dims]) if len(dims) else np.empty((0, n), np.int64)
        met = self.ids == own
        rows, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, upto = 0, 8
        while depth < n:
            upto = min(n, upto)
            fresh = np.zeros(n, dtype=bool)
            fresh[lists[:, depth:upto]] = True
            if not len(dims):
                fresh[:] = True
                upto = n
            fresh &= ~met
            new = np.flatnonzero(fresh)
            met |= fresh
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            if len(rows) > k:
                best = np.lexsort((rows, -scores))[:k]  # rows are in the order of ids
                rows, scores = rows[best], scores[best]
            depth, upto = upto, upto * 4
            if len(rows) >= k and len(dims):
                bound = (weights * self.vectors[lists[:, depth - 1], dims]).sum()
                if scores.min() > bound:
                    break
        best = np.lexsort((rows, -scores))[:k]
        return self.ids[rows[best]], scores[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length, filled up with zeros; floats where all sums are exact, for speed."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), max(1, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out


def quantised(vectors: DataFrame, id_col: str, vector: str, factor: float) -> DataFrame:
    """(vec_id, v): floor(factor * x) of each component; only whole, finite vectors."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long")).alias("v")))


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector: str = "embedding",
          factor: float = 256.0, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` holds, against all others."""
    whole = quantised(vectors, id_col, vector, factor)
    asked = quantised(vectors.where(is_query), id_col, vector, factor)
    n_blocks = max(1, -(-whole.count() // block))
    n_asked = max(1, -(-asked.count() // block))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    met = (whole.select(dealt(n_blocks).alias("b"), every(n_asked).alias("a"), F.lit(False).alias("asks"), "vec_id", "v")
           .unionByName(asked.select(every(n_blocks).alias("b"), dealt(n_asked).alias("a"), F.lit(True).alias("asks"), "vec_id", "v")))

    def search(group: pa.Table) -> pa.Table:
        ids, asks = group.column("vec_id").to_numpy(), group.column("asks").to_numpy()
        matrix = _matrix(group.column("v"))
        if float(np.abs(matrix).max(initial=0)) ** 2 * matrix.shape[1] < 2 ** 53:
            matrix = matrix.astype(np.float64)
        lists = SortedLists(ids[~asks], matrix[~asks])
        found = [(int(q), *lists.top(q, row, k)) for q, row in zip(ids[asks], matrix[asks])]
        rows = [np.concatenate([x[i] for x in found]) if found else np.empty(0) for i in (1, 2)]
        return pa.table({"query_id": pa.array(np.repeat([x[0] for x in found], [len(x[1]) for x in found]).astype(np.int64)),
                         "vec_id": pa.array(rows[0].astype(np.int64)), "score": pa.array(rows[1].astype(np.int64))})

    best = met.groupBy("b", "a").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
