"""What the operators share: reading tables, cutting lineage, positions in a distributed order."""

from __future__ import annotations

import atexit
import contextlib
import mmap
import os
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyfold.session import scratch_dir

#: A word is a run of anything but ASCII white space (Java and DuckDB regex).
WORD = r"[^\x20\x09-\x0D]+"


#: Where this package lies.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_package(spark: SparkSession) -> None:
    """Python workers find this package wherever the driver was started (on a cluster it is installed on all machines)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


#: Arrays of a megabyte or more go back to the system when they are freed.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def workers_return_memory(spark: SparkSession) -> None:
    """Python workers, which live on from stage to stage, keep no freed memory; it costs some time in the system."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, remembered until ``release()``."""
    path = scratch_dir(spark, label)
    _scratch.append((spark, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: later steps survive lost executors without recomputing."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Delete what ``materialize()`` has written; call it when all results so far have been used."""
    while _scratch:
        spark, path = _scratch.pop()
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the session may be gone by now
        release()


class Shared:
    """An object that is broadcast; its arrays are read in place, from the file in which Spark hands a broadcast to Python workers.

    The workers of an executor map that file, so they hold the arrays once, in the
    system's page cache, and not in a copy each. ``value`` is read-only there.
    """

    MARK, ALIGN = b"keyfold shared object", 64
    _opened: dict = {}

    def __init__(self, sc, value: object):
        buffers: list[pickle.PickleBuffer] = []
        head = pickle.dumps(value, 5, buffer_callback=buffers.append)
        raw = [b.raw() for b in buffers]
        # Where a long byte array lies in its pickle, so that arrays are aligned in the file
        lead = pickle.dumps(bytearray(self.MARK + bytes(1 << 18)), 5).index(self.MARK)
        sizes = [len(head), *map(len, raw)]
        table = len(self.MARK) + 8 * (1 + len(sizes))
        places, at = [], table
        for size in sizes:
            at += -(at + lead) % self.ALIGN
            places.append(at)
            at += size
        blob = bytearray(max(at, 1 << 18))
        blob[:table] = self.MARK + b"".join(n.to_bytes(8, "little") for n in (len(sizes), *sizes))
        for place, part in zip(places, (head, *raw)):
            blob[place:place + len(part)] = part
        self.lead, self.places = lead, places
        self.broadcast = sc.broadcast(blob)

    def __getstate__(self) -> dict:
        return {"broadcast": self.broadcast, "lead": self.lead, "places": self.places}

    @property
    def value(self):
        made = getattr(self.broadcast, "_jbroadcast", None)
        key = made.id() if made is not None else getattr(self.broadcast, "_path", None) or id(self.broadcast)
        if key not in Shared._opened:
            for old in [k for k in Shared._opened if isinstance(k, str) and not os.path.exists(k)]:
                del Shared._opened[old]
            Shared._opened[key] = self._open()
        return Shared._opened[key]

    def _open(self):
        path, view = getattr(self.broadcast, "_path", None), None
        if path and os.path.exists(path):
            with open(path, "rb") as f:
                mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            begin = mapped.find(self.MARK, 0, 4096)
            view = memoryview(mapped)[begin:] if begin >= 0 else None
        if view is None:  # a worker may get it by another way, as with encryption
            view = memoryview(self.broadcast.value)
        n = int.from_bytes(view[len(self.MARK):len(self.MARK) + 8], "little")
        table = view[len(self.MARK) + 8:len(self.MARK) + 8 * (n + 1)]
        parts = [view[a:a + int.from_bytes(table[8 * i:8 * i + 8], "little")] for i, a in enumerate(self.places)]
        return pickle.loads(parts[0], buffers=parts[1:])

    def destroy(self) -> None:
        made = getattr(self.broadcast, "_jbroadcast", None)
        Shared._opened.pop(made.id() if made is not None else None, None)
        self.broadcast.destroy()


def batches_of_texts(batch: pa.RecordBatch, column: str = "text", limit: int = 512 << 10) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end row, UTF-8 texts; null: empty) of a batch, in slices of about ``limit`` bytes.

    Only bounds memory: a text is never split, every row is in one slice.
    """
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    first, size, texts = 0, 0, []
    for row, value in enumerate(col):
        data = value.as_py() or b""
        if texts and size + len(data) > limit:
            yield first, row, texts
            first, size, texts = row, 0, []
        texts.append(data)
        size += len(data)
    if texts:
        yield first, first + len(texts), texts


def pieces(df: DataFrame, rows_per_piece: int) -> int:
    """How many pieces a group of any share of ``df`` needs; grows with the row count."""
    return max(8, -(-df.count() // rows_per_piece))


def running_total(df: DataFrame, keys: list[str], order: list[Column], amount: Column, out: str,
                  n_pieces: int) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows before this one within ``keys``.

    A plain window would bring a hot key's rows into one task. Here each key is
    cut into ``n_pieces`` pieces by a hash of the order columns; piece sums are
    one small row per (key, piece), and only a window over those spans a key.
    The order is (piece, order columns): fixed, but not the plain sort order.
    """
    df = df.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(n_pieces)).cast("int")).withColumn("_amount", amount)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = (df.groupBy(*keys, "_piece").agg(F.sum("_amount").alias("_sum"))
            .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
            .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_piece").alias("_kp"), "_base"))
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(sums, [*same, F.col("_piece") == F.col("_kp")])
    return (joined.withColumn(out, F.col("_base") + F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .drop("_piece", "_amount", "_base", "_kp", *[f"_k{i}" for i in range(len(keys))]))
