"""Document fingerprints by MinHash, their likeness, and near duplicates by signature bands.

A signature holds, for each of ``PERMUTATIONS`` universal hash functions
(multiply-add-shift on 64 bits), the least value over the text's distinct word
shingles. The fingerprint keeps eight bits of each, as hexadecimal text; the
share of equal places, corrected for the one place in 256 that agrees by
chance, estimates the Jaccard similarity. Near duplicates are found by joining
bands of the full signatures, and verified by the exact Jaccard similarity.

Cases: a null text is empty; texts without words share one fingerprint (all
zeros) and are near duplicates of nothing; fewer than five words are one
shingle; equal texts have equal fingerprints; repeated ids follow one another,
ordered by text; null ids come last; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import batches_of_texts, materialize
from keyfold.llm.components import stars
from keyfold.llm.ngram_join import class_key, similar
from keyfold.llm.words import mix, shingle_sets

PERMUTATIONS = 256
BANDS = 64
#: Text bytes per bucket of the document order.
BUCKET_BYTES = 16 << 20
#: The rounds with hubs go on while more pairs than that per class and band are left.
MOST_PAIRS = 8
_NOTHING = np.iinfo(np.uint32).max


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return seeds[:count] | np.uint64(1), seeds[count:]


def signature(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Least 32-bit hash of the shingles under each function; of none, the largest value."""
    a, b = _functions(permutations)
    out = np.full(permutations, _NOTHING, dtype=np.uint32)
    for at in range(0, len(shingles), 1024):
        hashed = (shingles[at:at + 1024, None] * a + b) >> np.uint64(32)
        np.minimum(out, hashed.min(axis=0).astype(np.uint32), out=out)
    return out


def fingerprint(shingles: np.ndarray) -> bytes:
    """Eight bits of each place of the signature."""
    if not len(shingles):
        return bytes(PERMUTATIONS)
    least = signature(shingles).astype(np.uint64) + (np.arange(PERMUTATIONS, dtype=np.uint64) << np.uint64(32))
    return (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    equal = (np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean()
    return float(max(0.0, (equal - 1 / 256) / (1 - 1 / 256)))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def in_order(docs: DataFrame, text: str, id_col: str, buckets: int) -> DataFrame:
    """(bucket, ahead, doc_id, text): documents by descending id, dealt into ranges.

    Each range also gets, marked ``ahead``, the first documents of the next one
    (the last range those of the first), so every document finds its follower
    in its own range. Only range bounds reach the driver.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    tops = sorted((r[0] for r in rows.select("key").repartitionByRange(buckets, "key")
                   .groupBy(F.spark_partition_id()).agg(F.max("key")).select("max(key)").collect()), reverse=True)
    if not tops:
        return rows.select(F.lit(0).alias("bucket"), F.lit(False).alias("ahead"), "key", "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(np.array(tops[::-1], dtype=np.int64))

    @F.pandas_udf("bucket int, top boolean")
    def bucket_of(keys: pd.Series) -> pd.DataFrame:
        ascending = shared.value
        at = np.searchsorted(ascending, keys.to_numpy())
        return pd.DataFrame({"bucket": (len(ascending) - 1 - at).astype("int32"), "top": ascending[at] == keys.to_numpy()})

    rows = rows.withColumn("_in", bucket_of("key"))
    before = F.pmod(F.col("_in.bucket") - 1, F.lit(len(tops)))
    own = F.struct(F.col("_in.bucket").alias("bucket"), F.lit(False).alias("ahead"))
    copy = F.struct(before.alias("bucket"), F.lit(True).alias("ahead"))
    return (rows.withColumn("_at", F.explode(F.when(F.col("_in.top"), F.array(own, copy)).otherwise(F.array(own))))
            .select("_at.bucket", "_at.ahead", "key", "doc_id", "text"))


def with_followers(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every document."""
    size = docs.agg(F.sum(F.length(F.col(text).cast("string")))).first()[0] or 0
    buckets = max(12, -(-size // BUCKET_BYTES))
    placed = in_order(docs, text, id_col, buckets)
    placed = (placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "ahead", F.col("key").desc(), "text")
              .select("bucket", "ahead", "doc_id", "text"))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, int | None, str]]:
        for batch in parts:
            yield from zip(*[batch.column(i).to_pylist() for i in range(3)], (v.as_py() for v in batch.column(3)))

    def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
        """Runs of documents of a bucket, the last of which only follows."""
        run, size, bucket, closed = [], 0, None, False
        for b, ahead, doc, value in rows(parts):
            if b != bucket:
                run, size, bucket, closed = [], 0, b, False
            if closed:
                continue  # more rows ahead: only the first follows
            run.append((doc, value))
            size += len(value)
            if ahead or size > 2 << 20 and len(run) > 1:
                yield run
                run, size, closed = [run[-1]], len(value), ahead

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in slices(parts):
            values = [v for _, v in run]
            changed = [edited(a, b).encode() for a, b in zip(values, values[1:])]
            prints = [fingerprint(s) for s in shingle_sets([v.encode() for v in values])]
            edits = [fingerprint(s) for s in shingle_sets(changed)]
            yield pa.RecordBatch.from_arrays([
                pa.array([d for d, _ in run[:-1]], pa.int64()), pa.array([len(v) for v in values[:-1]], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
                pa.array([p.hex() for p in prints[:-1]], pa.string()), pa.array([p.hex() for p in edits], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(prints, edits)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(prints, prints[1:])], pa.float64())],
                names=[f.split()[0] for f in schema.split(", ")])

    return placed.mapInArrow(compare, schema)


def banded(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, cls, n, h, bands): shingle set, its key, and one hash per band of the signature."""

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, end, texts in batches_of_texts(batch):
                sets = shingle_sets(texts)
                bands = []
                for s in sets:
                    if len(s):
                        rows = signature(s).reshape(BANDS, -1).astype(np.uint64)
                        key = np.arange(BANDS, dtype=np.uint64)
                        for i in range(rows.shape[1]):
                            key = mix((key << np.uint64(8)) + mix(rows[:, i] + np.uint64(i << 32)))
                        bands.append(key.view(np.int64))
                    else:
                        bands.append([])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([class_key(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "cls", "n", "h", "bands"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(sign, "doc_id long, cls binary, n long, h array<long>, bands array<long>"))


def near_duplicates(docs: DataFrame, *, threshold: float = 0.75, text: str = "text", id_col: str = "doc_id",
                    hub_rounds: int = 12) -> DataFrame:
    """(doc_id, component_id) by bands joined in Spark, every link verified by Jaccard similarity.

    Equal sets are one class first. In each round the classes of a bucket of a
    band are compared with one hub, and those in the hub's component are skipped.
    All classes stay in their buckets. When few enough pairs are left across
    components (or after ``hub_rounds`` rounds), all of them are compared, so no
    link between components that share a bucket is missed.
    """
    signed = materialize(banded(docs, text=text, id_col=id_col), "minhash-bands")
    classes = materialize(signed.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("h").alias("h"), F.first("bands").alias("bands")), "minhash-classes")
    members = materialize(classes.select("cls", F.explode("bands").alias("band")), "minhash-members")
    of = lambda side: classes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"), F.col("h").alias(f"h{side}"))
    size = members.count()
    labels = done = None
    for turn in range(hub_rounds + 1):
        held = members if labels is None else members.join(labels, "cls", "left")
        held = held.withColumn("label", F.coalesce("label", "cls") if labels is not None else F.col("cls"))
        # buckets that still hold two components, and their pairs across them
        hub = F.min_by(F.struct("cls", "label"), F.xxhash64("cls", F.lit(turn)))
        parts = held.groupBy("band", "label").agg(F.count("*").alias("k"), hub.alias("hub"))
        open_ = materialize(parts.groupBy("band").agg(
            F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("inside"), F.count("*").alias("parts"),
            F.min_by("hub", F.xxhash64("hub.cls", F.lit(turn))).alias("hub")).where("parts > 1"), "minhash-open")
        left = open_.agg(F.sum((F.col("k") * F.col("k") - F.col("inside")) / 2)).first()[0] or 0
        if not left:
            break
        every = turn == hub_rounds or left <= MOST_PAIRS * size
        mine = held.select("band", F.col("cls").alias("b"), F.col("label").alias("lb"))
        if every:
            other = held.join(open_.select("band"), "band", "left_semi").select("band", F.col("cls").alias("a"), F.col("label").alias("la"))
        else:
            other = open_.select("band", F.col("hub.cls").alias("a"), F.col("hub.label").alias("la"))
        across = F.col("la") < F.col("lb") if every else F.col("la") != F.col("lb")
        pairs = other.join(mine, "band").where(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "minhash-pairs")
        found = materialize(pairs.join(of("a"), "a").join(of("b"), "b").where(
            similar(F.size(F.array_intersect("ha", "hb")), F.col("na"), F.col("nb"), threshold)).select("a", "b"), "minhash-links")
        done = pairs if done is None else done.unionByName(pairs)
        if found.take(1):
            known = found if labels is None else found.unionByName(labels.select(F.col("cls").alias("a"), F.col("label").alias("b")))
            labels = materialize(stars(known).select(F.col("node").alias("cls"), F.col("root").alias("label")), "minhash-labels")
        if every:
            break
    named = classes.select("cls", "least")
    if labels is not None:
        named = named.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        named = named.join(named.groupBy("label").agg(F.min("least").alias("root")), "label").select("cls", F.col("root").alias("least"))
    return signed.select("doc_id", "cls").join(named, "cls", "left").select(
        "doc_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns (hexadecimal)."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(bytes.fromhex(p), bytes.fromhex(q)) if p and q else None for p, q in zip(x, y)], dtype="float64")

    return compare(a, b)
