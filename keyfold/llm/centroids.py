"""Exact k-means on integer vectors, with heaps of bounds that expire.

Every vector lies in the heap of its cluster under the key "gap + drift so far":
the gap is the distance to the second nearest centroid less that to the
nearest, when it was last scanned; the drift of a cluster is what its centroid
and the farthest-moving other one have moved since the start, added up. As long
as the key exceeds the cluster's drift, the nearest centroid can't have changed.
A round pops only the keys that the drift has reached, scans those vectors
against all centroids, in integers, and pushes them again. Sums of a cluster
change by the vectors that enter or leave it.

Vectors are packed into shards of ``SHARD`` rows, written once as a table that
is bucketed by shard; the heaps are a table bucketed alike, written anew each
round. So a round joins the two without shuffling either, and a lost task reads
its bucket again. What the driver holds is k centroids and their sums.

Cases: vectors that are null, of another width, or hold null, NaN or infinite
components are left out; components beyond ±2^26 after scaling are cut to that
(distances then fit 64 bits); rows of null id are clustered, but never a start;
repeated ids are separate vectors (as starts, in the order of their components);
equal distances go to the smaller number; empty clusters stay where they are;
with fewer vectors than clusters there are fewer clusters; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import scratch

#: Vectors of a shard, and shards of a bucket.
SHARD, SHARDS_PER_BUCKET = 4096, 16
#: Largest component after scaling.
LIMIT = 1 << 26


class Heaps:
    """One heap of (key, row) per cluster."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def of(cls, sizes: list[int], keys: bytes, rows: bytes) -> Heaps:
        # arrays keep the heap's order, so nothing is sifted again
        pairs = list(zip(np.frombuffer(keys, np.float64).tolist(), np.frombuffer(rows, np.int32).tolist()))
        ends = np.cumsum(sizes)
        return cls([pairs[end - size:end] for size, end in zip(sizes, ends)])

    def columns(self) -> dict:
        pairs = [p for heap in self.heaps for p in heap]
        return {"sizes": [len(h) for h in self.heaps], "keys": np.array([p[0] for p in pairs], np.float64).tobytes(),
                "rows": np.array([p[1] for p in pairs], np.int32).tobytes()}

    def expired(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their cluster): taken off all heaps as far as the drift has come."""
        rows, owner = [], []
        for c, heap in enumerate(self.heaps):
            before = len(rows)
            while heap and heap[0][0] <= drift[c]:
                rows.append(heapq.heappop(heap)[1])
            owner += [c] * (len(rows) - before)
        return np.array(rows, np.int64), np.array(owner, np.int64)

    def push(self, rows: np.ndarray, cluster: np.ndarray, keys: np.ndarray) -> None:
        for c, heap in enumerate(self.heaps):
            mine = cluster == c
            new = list(zip(keys[mine].tolist(), rows[mine].tolist()))
            if len(new) * 4 > len(heap):
                heap.extend(new)
                heapq.heapify(heap)
            else:
                for pair in new:
                    heapq.heappush(heap, pair)

    def clusters(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int32)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, exact: in floats where these are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, x.shape[1]) < 1 << 53 else np.int64
    x, c = x.astype(kind), centroids.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, gap to the second nearest, never too large)."""
    far = squared(x, centroids)
    best = far.argmin(axis=1)
    if len(centroids) == 1:
        return best, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(np.float64))
    return best, two[:, 1] - two[:, 0] - 1e-12 * (two[:, 0] + two[:, 1])


def quantised(vectors: DataFrame, *, width: int, factor: float, id_col: str, vector: str) -> DataFrame:
    """(vec_id, v): floor(factor * x) of each component, of the vectors that take part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = lambda x: F.greatest(F.least(F.floor(F.lit(float(factor)) * x.cast("double")), F.lit(LIMIT)), F.lit(-LIMIT))
    return vectors.where((F.size(vector) == width) & whole).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: scaled(x).cast("long")).alias("v"))


def _shards(kept: DataFrame, width: int) -> DataFrame:
    """(shard, ids, x): rows packed where they are."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in parts:
            part = batch.column(0)[0].as_py() if batch.num_rows else 0
            for at in range(0, batch.num_rows, SHARD):
                rows = batch.slice(at, SHARD)
                x = rows.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, width)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part << 32 | made], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(1)),
                    pa.array([x.tobytes()], pa.binary())], names=["shard", "ids", "x"])
                made += 1

    return kept.select(F.spark_partition_id().cast("long").alias("part"), "vec_id", "v").mapInArrow(pack, "shard long, ids array<long>, x binary")


_HEAPS = "shard long, sizes array<long>, keys binary, rows binary, sums array<long>, scanned long"


def _assign(centroids: np.ndarray, drift: np.ndarray):
    """A round for shards with their heaps (of the first round: without)."""
    k, width = centroids.shape
    schema = pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("keys", pa.binary()), ("rows", pa.binary()),
                        ("sums", pa.list_(pa.int64())), ("scanned", pa.int64())])

    def step(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                x = np.frombuffer(row["x"], np.int32).reshape(-1, width).astype(np.int64)
                change = np.zeros((k, width + 1), np.int64)  # of sums and counts
                with_one = lambda at: np.concatenate((x[at], np.ones((len(at), 1), np.int64)), axis=1)
                if "keys" in row:
                    heaps = Heaps.of(row["sizes"], row["keys"], row["rows"])
                    rows, old = heaps.expired(drift)
                    best, gap = scan(x[rows], centroids)
                    moved = best != old
                    np.subtract.at(change, old[moved], with_one(rows[moved]))
                else:
                    heaps, rows = Heaps([[] for _ in range(k)]), np.arange(len(x))
                    best, gap = scan(x, centroids)
                    moved = np.ones(len(x), dtype=bool)
                np.add.at(change, best[moved], with_one(rows[moved]))
                heaps.push(rows, best, gap + drift[best])
                yield pa.RecordBatch.from_pylist([{"shard": row["shard"], **heaps.columns(), "sums": change.ravel().tolist(), "scanned": len(rows)}], schema=schema)

    return step


class Clustering:
    """What ``fit`` gives: centroids, how many vectors each round scanned, and the assignment of each vector."""

    def __init__(self, centroids: np.ndarray, scanned: list[int], assigned: DataFrame):
        self.centroids, self.scanned, self.assigned = centroids, scanned, assigned


def fit(vectors: DataFrame, *, k: int = 8, rounds: int = 10, width: int = 64, factor: float = 1024.0, salt: str = "3:",
        id_col: str = "vec_id", vector: str = "embedding") -> Clustering | None:
    """Lloyd's rounds, then one more assignment; None without vectors.

    Starts: the k vectors with the least SHA-256 of ``salt`` and id.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors, width=width, factor=factor, id_col=id_col, vector=vector)
    starts = (kept.where("vec_id is not null")
              .orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256), "vec_id", "v").limit(k).collect())
    if not starts:
        return None
    centroids = np.array([r.v for r in starts], np.int64)
    k = len(centroids)
    buckets = max(spark.sparkContext.defaultParallelism, -(-kept.count() // (SHARD * SHARDS_PER_BUCKET)))

    def bucketed(df: DataFrame, label: str) -> DataFrame:
        name, path = f"{label}_{uuid.uuid4().hex}", scratch(spark, label)
        df.write.bucketBy(buckets, "shard").option("path", path).saveAsTable(name)
        return spark.table(name)

    x = bucketed(_shards(kept, width).repartition(buckets, "shard"), "cluster_vectors")
    drift, totals = np.zeros(k), np.zeros((k, width + 1), object)
    heaps, scanned = None, []
    for turn in range(rounds + 1):
        met = x.select("shard", "x") if heaps is None else x.select("shard", "x").join(heaps.drop("sums", "scanned").hint("merge"), "shard")
        heaps = bucketed(met.mapInArrow(_assign(centroids, drift), _HEAPS), "cluster_heaps")
        changed = heaps.select(F.posexplode("sums").alias("i", "amount")).groupBy("i").agg(F.sum("amount").alias("amount")).collect()
        scanned.append(heaps.agg(F.sum("scanned")).first()[0])
        if turn == rounds:
            break
        for r in changed:  # k * (width + 1) numbers
            totals[r.i // (width + 1), r.i % (width + 1)] += r.amount
        before = centroids.copy()
        for c in range(k):
            if totals[c, width]:
                centroids[c] = [int(s) // int(totals[c, width]) for s in totals[c, :width]]
        moved = np.array([math.sqrt(int(d)) * (1 + 1e-12) for d in ((centroids - before) ** 2).sum(axis=1)])
        most = np.array([max((moved[j] for j in range(k) if j != c), default=0.0) for c in range(k)])
        drift = (drift + moved + most) * (1 + 1e-12)

    final = centroids

    def distances(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for ids, row in zip(batch.column(1), batch.select(["x", "sizes", "keys", "rows"]).to_pylist()):
                v = np.frombuffer(row["x"], np.int32).reshape(-1, width).astype(np.int64)
                cluster = Heaps.of(row["sizes"], row["keys"], row["rows"]).clusters(len(v))
                far = ((v - final[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(cluster), pa.array(far)], names=["vec_id", "cluster", "distance"])

    assigned = x.join(heaps.drop("sums", "scanned").hint("merge"), "shard").mapInArrow(distances, "vec_id long, cluster int, distance long")
    return Clustering(final, scanned, assigned)


def cluster(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector that takes part."""
    spark = vectors.sparkSession
    done = fit(vectors, **options)
    if done is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    named = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(done.centroids)]
    # one row per cluster: sums in decimals, since those of all rows may pass 64 bits
    sums = {r.cluster: r.s for r in done.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    fits = lambda s: int(s) if s < 1 << 63 else None
    rows = [(c, fits(sums.get(c, 0)), fits(sum(sums.values())), sha) for c, sha in named]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
