"""Exact Jaccard join on word n-grams by vertical partitioning, and its components.

Documents with the same n-gram set form a class. The global n-gram order is cut
into fragments; a task holds one fragment of all classes:

1. In each fragment n-grams are counted over classes. Those of a single class
   can't overlap with anything; the others go on, with their frequency. A class
   with fewer of them than the threshold needs can't link and stops here.
2. The others keep them in the order of (frequency, hash). Two classes that
   link share an n-gram of their prefixes (prefix filter), so prefix n-grams
   yield the candidates.
3. A candidate pair's overlap is counted fragment by fragment and summed.

Components need not see every pair of a large family of near copies. In each
round every prefix n-gram names a few hubs among the classes that hold it (by the
same rule everywhere, so a family has few), and a class is compared with
the two hubs that it shares most prefix n-grams with. Classes already in one
component are not compared again, so the family soon is one component. When
few enough pairs are left across components (or after ``hub_rounds`` rounds),
all of them are checked, so no link between components is missed.

Cases: a null text or one without words has an empty set and links with
nothing; fewer than n words are one n-gram; repeated rows are one class; a row
of null id belongs to its class but names no component (null, if the component
has no other id); an empty table gives an empty result; other columns are
ignored. N-grams are told apart by 48 bits of their hash within a fragment (the
number of fragments grows with the input), classes by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import batches_of_texts, materialize
from keyfold.llm.components import stars
from keyfold.llm.words import shingle_sets

#: Text bytes whose n-grams make one fragment; about an eighth as many n-grams.
FRAGMENT_BYTES = 20 << 20
#: N-grams that a task gathers before it sends them to the fragments.
FLUSH = 300_000
#: At most so many ids (8 bytes each) are broadcast.
BROADCAST_IDS = 200_000
#: Hubs that each n-gram names in a round.
HUBS = 3
#: Fragments that an overlap is counted in.
SEGMENTS = 4


def class_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_keys(docs: DataFrame, n: int, text: str, id_col: str, same: bool = False) -> DataFrame:
    """(doc_id, n_shingles, cls); cls is null for the empty set. With ``same`` also the text's hash (xxhash64)."""
    extra = ["same"] if same else []

    def keys(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column(0)
            for first, end, texts in batches_of_texts(batch):
                sets = shingle_sets(texts, n)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([class_key(s) if len(s) else None for s in sets], pa.binary()),
                     *[batch.column(2).slice(first, end - first) for _ in extra]],
                    names=["doc_id", "n_shingles", "cls", *extra])

    texts = _texts(docs, text, id_col)
    return (texts.withColumn("same", F.xxhash64("text")) if same else texts).mapInArrow(
        keys, "doc_id long, n_shingles long, cls binary" + ", same long" * same)


def _texts(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def shared_ngrams(docs: DataFrame, features: Callable[[list[bytes]], list[tuple[bytes, np.ndarray]]], fragments: int,
                  text: str, id_col: str) -> DataFrame:
    """(cls, n, h, df): per class and fragment the names (``names_of``) of its hashes that other classes hold too, with their class counts.

    ``features``: class key (16 bytes) and sorted distinct 64-bit hashes of each text.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in parts:
            for _, _, texts in batches_of_texts(batch):
                for key, s in features(texts):
                    if len(s) and key not in held:  # a task sends a class once
                        held[key] = s
                        size += len(s)
                if size > FLUSH:
                    yield blocks(held)
                    held, size = {}, 0
        if held:
            yield blocks(held)

    def blocks(held: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(held), dtype="V16")
        lengths = np.array([len(s) for s in held.values()], dtype=np.int64)
        hashes = np.concatenate(list(held.values()))
        owner = np.repeat(np.arange(len(keys)), lengths)
        part = fragment_of(hashes, fragments)
        order = np.argsort(part, kind="stable")  # within a fragment by class, then by hash
        hashes, owner = hashes[order], owner[order]
        edges = np.searchsorted(part[order], np.arange(fragments + 1))
        rows = []
        for f in range(fragments):
            a, b = edges[f], edges[f + 1]
            if a < b:
                own, counts = np.unique(owner[a:b], return_counts=True)
                rows.append((f, keys[own].tobytes(), _narrow(counts), _narrow(lengths[own]), _low48(hashes[a:b])))
        return pa.RecordBatch.from_pylist([dict(zip(("f", "cls", "counts", "n", "h"), r)) for r in rows],
                                          schema=pa.schema([("f", pa.int32()), *[(c, pa.binary()) for c in ("cls", "counts", "n", "h")]]))

    def count(table: pa.Table) -> pa.Table:
        cls = np.frombuffer(b"".join(table.column("cls").to_pylist()), dtype="V16")
        counts, n_all = (np.concatenate([_widened(x.as_py(), len(c.as_buffer()) // 16) for x, c in zip(table.column(name), table.column("cls"))])
                         for name in ("counts", "n"))
        # several tasks may have sent the same class: count it once
        _, first = np.unique(cls, return_index=True)
        once = np.zeros(len(cls), dtype=bool)
        once[first] = True
        # a fragment is large: its hashes are widened in place and no copy outlives its use
        wide, at, sender = np.zeros((int(counts[once].sum()), 8), np.uint8), 0, 0
        for names, data in zip(table.column("cls"), table.column("h")):
            upto = sender + len(names.as_buffer()) // 16
            part = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, 6)
            if not once[sender:upto].all():
                part = part[np.repeat(once[sender:upto], counts[sender:upto])]
            wide[at:at + len(part), :6] = part
            at, sender = at + len(part), upto
        hashes = wide.view(np.uint64).ravel()
        hashes |= np.uint64(table.column("f")[0].as_py() % 65536) << np.uint64(48)
        cls, counts, n_all = cls[once], counts[once], n_all[once]
        owner = np.repeat(np.arange(len(cls), dtype=np.int32), counts)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        runs = np.diff(np.append(begins, len(ordered))).astype(np.int32)
        del ordered
        df = np.empty(len(hashes), dtype=np.int32)
        df[order] = np.repeat(runs, runs)
        del order
        shared = df > 1
        own, sizes = np.unique(owner[shared], return_counts=True)
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        return pa.table({"cls": pa.array([cls[i].tobytes() for i in own], pa.binary()), "n": pa.array(n_all[own], pa.int32()),
                         "h": pa.ListArray.from_arrays(offsets, pa.array(hashes[shared].view(np.int64))),
                         "df": pa.ListArray.from_arrays(offsets, pa.array(df[shared]))})

    sent = _texts(docs, text, id_col).mapInArrow(cut, "f int, cls binary, counts binary, n binary, h binary")
    return sent.groupBy("f").applyInArrow(count, "cls binary, n int, h array<long>, df array<int>")


def names_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """What ``shared_ngrams`` calls these hashes: their lowest 48 bits and their fragment."""
    return hashes & np.uint64((1 << 48) - 1) | (fragment_of(hashes, fragments) % 65536).astype(np.uint64) << np.uint64(48)


def _low48(hashes: np.ndarray) -> bytes:
    """The lowest six bytes of each hash; the fragment stands for the others."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _narrow(numbers: np.ndarray) -> bytes:
    """Positive numbers in as many bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()))).tobytes()


def _widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_narrow``."""
    return np.frombuffer(data, dtype=f"u{len(data) // n}").astype(np.int32)


def fragment_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


def linkable(shared: DataFrame, threshold: float) -> DataFrame:
    """(id, cls, n, h): classes with enough shared n-grams for a link, these in the order of (frequency, hash).

    The ids are short names for joins; they hold once the result is written.
    """
    whole = shared.groupBy("cls", "n").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("df", "h")))).alias("z"))
    return (whole.where(F.size("z") >= F.ceil(F.lit(threshold) * F.col("n")))
            .select(F.monotonically_increasing_id().alias("id"), "cls", "n", F.col("z.h").alias("h")))


def needed(na: Column, nb: Column, threshold: float) -> Column:
    """The least overlap of a link between classes of these sizes."""
    hundredths = round(threshold * 100)
    return F.ceil((na + nb) * hundredths / (100 + hundredths)).cast("int")


def meetings(na: Column, nb: Column, threshold: float) -> Column:
    """How many n-grams a pair that links has in common before the last ``needed - meetings`` of either class.

    Of the common n-grams at most so many as lie behind that place in one class
    are left out, so the others are ``meetings`` at least. That place lies within
    the prefixes, which end where ceil(threshold * n) - 1 n-grams are left.
    """
    least = F.ceil(F.lit(threshold) * F.greatest(na, nb)).cast("int")
    return F.least(_spare(F.least(na, nb)), needed(na, nb, threshold) - least + 1)


def _spare(n: Column) -> Column:
    return F.shiftright(n, 4) + 1


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, overlap): counted in each segment of the order, then summed.

    While the pairs name few classes (counted first), the others' segments are
    left out by a broadcast of those names, before anything is shuffled.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        segments = segments.join(F.broadcast(ids), "id", "left_semi")
    left = segments.select(F.col("id").alias("a"), "s", F.col("h").alias("ha"))
    right = segments.select(F.col("id").alias("b"), "s", F.col("h").alias("hb"))
    part = pairs.join(left, "a").join(right, ["b", "s"]).select(
        "a", "b", F.size(F.array_intersect("ha", "hb")).alias("o"))
    return part.groupBy("a", "b").agg(F.sum("o").alias("overlap"))


def similar(overlap: Column, na: Column, nb: Column, threshold: float) -> Column:
    """Jaccard of at least ``threshold``, in whole hundredths: exact."""
    hundredths = round(threshold * 100)
    return 100 * overlap >= hundredths * (na + nb - overlap)


def component_labels(candidates: DataFrame, threshold: float, hub_rounds: int, most_pairs: int = 8) -> DataFrame | None:
    """(id, label) of candidates that link; None without any link. ``candidates``: (id, n, h).

    ``most_pairs``: the rounds go on while more pairs than that per prefix
    n-gram are left to check.
    """
    least = F.ceil(F.lit(threshold) * F.col("n")).cast("int")
    # rest: how many n-grams come after this one
    prefix = candidates.select("id", "n", F.size("h").alias("size"), F.posexplode(F.slice("h", F.lit(1), F.size("h") - least + 1)).alias("at", "p"))
    prefix = materialize(prefix.select("id", "n", "p", (F.col("size") - 1 - F.col("at")).alias("rest")), "join-prefix")
    within = lambda s: F.filter("h", lambda h: F.shiftright(h, 40).bitwiseAND(F.lit(SEGMENTS - 1)) == s)
    cut = F.array(*[F.struct(F.lit(s).alias("s"), within(s).alias("h")) for s in range(SEGMENTS)])
    segments = materialize(candidates.select("id", F.inline(cut)).where(F.size("h") > 0), "join-segments")
    sizes = candidates.select("id", "n")
    rows = prefix.count()
    na, nb = F.col("na"), F.col("nb")
    meet = meetings(na, nb, threshold)
    early = F.least("resta", "restb") >= needed(na, nb, threshold) - meet
    # the smaller class of a pair meets the other early
    first = F.col("rest") >= needed(F.col("n"), F.col("n"), threshold) - _spare(F.col("n"))
    labels = done = None
    for turn in range(hub_rounds + 1):
        held = prefix if labels is None else prefix.join(labels, "id", "left")
        held = held.withColumn("label", F.coalesce("label", "id") if labels is not None else F.col("id"))
        # n-grams that still hold two components, and their pairs across them
        parts = held.select("p", first.cast("long").alias("early"), F.lit(1).alias("k"))
        if labels is not None:
            parts = held.groupBy("p", "label").agg(F.sum(first.cast("long")).alias("early"), F.count("*").alias("k"))
        across = F.sum("early") * F.sum("k") - F.sum(F.col("early") * F.col("k"))
        open_ = materialize(parts.groupBy("p").agg(across.alias("across")).where("across > 0"), "join-open")
        left = open_.agg(F.sum("across")).first()[0] or 0
        if not left:
            break
        every = turn == hub_rounds or left <= most_pairs * rows
        mine = held.select("p", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"), F.col("rest").alias("restb"))
        able = held.where(first).join(open_.select("p"), "p", "left_semi")
        if every:
            other = able.select("p", F.col("id").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("rest").alias("resta"))
            met = other.join(mine, "p").where((F.col("la") != F.col("lb")) & ((na < nb) | ((na == nb) & (F.col("a") < F.col("b")))) & early)
            common = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c")).where(F.col("c") >= meet)
            pairs = common.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        else:
            # the same few hubs for all of a family
            hubs = [F.min_by(F.struct("id", "n", "label", "rest"), F.xxhash64("id", F.lit(turn * HUBS + i))) for i in range(HUBS)]
            other = able.groupBy("p").agg(F.array_distinct(F.array(*hubs)).alias("hubs"))
            other = other.select("p", F.explode("hubs").alias("hub")).select(
                "p", F.col("hub.id").alias("a"), F.col("hub.n").alias("na"), F.col("hub.label").alias("la"), F.col("hub.rest").alias("resta"))
            met = other.join(mine, "p").where((F.col("la") != F.col("lb")) & early)
            common = met.groupBy("a", "b").agg(F.count("*").alias("c"))
            best = Window.partitionBy("b").orderBy(F.col("c").desc(), "a")
            pairs = (common.withColumn("r", F.row_number().over(best)).where("r <= 2")
                     .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "join-pairs")
        found = (overlaps(pairs, segments)
                 .join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a")
                 .join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
                 .where(similar(F.col("overlap"), F.col("na"), F.col("nb"), threshold)).select("a", "b"))
        found = materialize(found, "join-links")
        done = pairs if done is None else done.unionByName(pairs)
        if found.take(1):
            known = found if labels is None else found.unionByName(labels.select(F.col("id").alias("a"), F.col("label").alias("b")))
            labels = materialize(stars(known).select(F.col("node").alias("id"), F.col("root").alias("label")), "join-labels")
        if every:
            break
    return labels


def near_duplicates(docs: DataFrame, *, n: int = 5, threshold: float = 0.75, text: str = "text", id_col: str = "doc_id",
                    hub_rounds: int = 12) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    return components(docs, n=n, threshold=threshold, text=text, id_col=id_col, hub_rounds=hub_rounds).select(
        "doc_id", "n_shingles", "component_id")


def components(docs: DataFrame, *, n: int = 5, threshold: float = 0.75, text: str = "text", id_col: str = "doc_id",
               hub_rounds: int = 12, same: bool = False) -> DataFrame:
    """``near_duplicates`` with ``component``, a key that components without any id have too (null for the empty set).

    With ``same`` also the text's hash, which tells rows of one id or of null id apart.
    """
    size = docs.agg(F.sum(F.length(F.col(text).cast("string")))).first()[0] or 0
    fragments = max(12, -(-size // FRAGMENT_BYTES))
    keys = materialize(set_keys(docs, n, text, id_col, same), "join-keys")
    features = lambda texts: [(class_key(s), s) for s in shingle_sets(texts, n)]
    candidates = materialize(linkable(shared_ngrams(docs, features, fragments, text, id_col), threshold), "join-linkable")
    labels = component_labels(candidates, threshold, hub_rounds)
    classes = keys.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("component_id")).withColumn("component", F.col("cls"))
    if labels is not None:
        named = labels.join(candidates.select("id", "cls"), "id").join(classes, "cls")
        roots = named.groupBy("label").agg(F.min("component_id").alias("root_id"), F.min("cls").alias("root"))
        named = named.join(roots, "label").select("cls", "root_id", "root")
        classes = classes.join(named.withColumn("linked", F.lit(True)), "cls", "left").select(
            "cls", F.when(F.col("linked"), F.col("root_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("root", "component").alias("component"))
    return (keys.join(classes, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "component", *["same"] * same))
