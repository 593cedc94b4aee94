"""Repeated passages across documents, by sharded enhanced suffix arrays.

A suffix array over a whole corpus is no Spark job, so suffixes are sampled and
sharded by content. In every ``min_bytes`` window the ``K``-gram with the least
hash is its anchor; equal windows have equal anchors, so all occurrences of a
repeated passage meet in the shard of their anchors.

1. Anchors that only one text holds are dropped (``ngram_join.shared_ngrams``,
   one shuffle of anchor hashes; copies of a whole text count as one).
2. The others are sent to their shards with the bytes around them. A shard sorts
   the suffixes that start at its anchors, with the common-prefix lengths of
   neighbours: an enhanced suffix array. A scan with a stack lists its
   common-prefix intervals; the members of each interval are sorted and scanned
   once more by the bytes to their left. A left interval whose members differ in
   what precedes them is a maximal repeat (as far as the context reaches: one
   window on either side) with all its occurrences.
3. A repeat covers its bytes in every document but those of its least id.

Whole copies need no suffixes: every window of theirs starts in the first copy.

Cases: a null text is empty; texts shorter than ``min_bytes`` lose and cover
nothing; rows with equal ids don't cover each other; null ids count as larger
than all others; an empty table gives an empty result; other columns are ignored
unless kept by name. Texts are told apart by their MD5, anchors by 64-bit hashes
(the bytes themselves are compared in the shards).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import batches_of_texts, materialize
from keyfold.llm.ngram_join import fragment_of, names_of, shared_ngrams
from keyfold.llm.words import mix

#: Bytes of an anchor.
K = 20
#: Bytes of context that a task gathers before it sends them to the shards.
FLUSH = 4 << 20
#: Text bytes whose anchors make one shard.
SHARD_BYTES = 6 << 20
#: Suffixes of a shard that are compared at once.
SLICE = 1 << 15
#: Spans that a shard holds before it merges them.
MERGE_AT = 100_000
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _grams(data: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of the k bytes from each place, by doubling."""
    have, size, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if k & size:
            # the parts of k's binary form, one after another
            out = have if out is None else out[:len(have) - done] * _power(size) + have[done:] if done else have
            done += size
        if done == k:
            return mix(out[:len(data) - k + 1])
        have = have[:-size] * _power(size) + have[size:] if len(have) > size else have[:0]
        size *= 2


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best over each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


def anchors(text: bytes, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the K-grams that are least in some window of ``min_bytes``."""
    if len(text) < min_bytes:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = _grams(np.frombuffer(text, np.uint8), K)
    width = min_bytes - K + 1
    least = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), width, np.maximum) == hashes)
    # least hashes are small: mix them again, so that they spread over the shards
    return places, mix(hashes[places] + np.uint64(1))


def text_key(text: bytes) -> bytes:
    return hashlib.md5(text).digest()


def _prefix_lengths(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before; the first: 0."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def _sorted(rows: np.ndarray, *first: np.ndarray) -> np.ndarray:
    """Order of byte rows, after the keys ``first``."""
    # the last key first; eight bytes are widened at a time
    order = np.arange(len(rows))
    for at in range((rows.shape[1] - 1) // 8 * 8, -1, -8):
        wide = np.zeros((len(rows), 8), np.uint8)
        wide[:, :rows.shape[1] - at] = rows[:, at:at + 8]
        order = order[np.argsort(wide.view(">u8").ravel().astype(np.uint64)[order], kind="stable")]
    for key in first[::-1]:
        order = order[np.argsort(key[order], kind="stable")]
    return order


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(from, to, common prefix) of all common-prefix intervals of at least ``least`` bytes: a scan with a stack."""
    stack: list[tuple[int, int]] = []  # (prefix, from)
    for at, now in enumerate([*lcp, 0]):
        begin = at - 1
        while stack and stack[-1][0] > now:
            size, begin = stack.pop()
            yield begin, at, size
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, begin))


class Shard:
    """Sampled suffixes with what lies to their left."""

    def __init__(self, right: np.ndarray, n_right: np.ndarray, left: np.ndarray, n_left: np.ndarray, min_bytes: int):
        self.order = _sorted(right)
        self.min_bytes = min_bytes
        self.left, self.n_left = left[self.order], n_left[self.order]
        self.lcp = np.zeros(len(right), np.int64)
        for at in range(0, len(right), SLICE):  # each with the row before it
            rows = self.order[max(0, at - 1):at + SLICE]
            self.lcp[at:at + SLICE] = _prefix_lengths(right[rows], n_right[rows])[min(at, 1):]
        self.lcp[self.lcp < K] = 0  # another anchor

    def groups(self, batch: int = 60_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """All maximal repeats, in batches: (members, as rows of the input; members of each; bytes to the left; to the right).

        Pairs, which most anchors are, are done all at once.
        """
        linked = self.lcp > 0
        ends = np.append(linked[1:], False)
        pair = np.flatnonzero(linked & ~ends & ~np.roll(linked, 1))
        left = self._left_lcp(pair, pair - 1)
        good = left + self.lcp[pair] >= self.min_bytes
        pair, left = pair[good], left[good]
        yield np.stack([self.order[pair - 1], self.order[pair]], axis=1).ravel(), np.full(len(pair), 2), left, self.lcp[pair]
        lcp = self.lcp.copy()
        lcp[linked & ~ends & ~np.roll(linked, 1)] = 0
        at = np.flatnonzero(lcp)
        if not len(at):
            return
        # scan only the stretches that have larger groups
        keep = np.unique(np.concatenate((at - 1, at)))
        members, sizes, lefts, rights, held = [], [], [], [], 0
        for begin, end, right in intervals(lcp[keep].tolist(), K):
            for rows, to_left in self._by_left(keep[begin:end], right):
                members.append(self.order[rows])
                sizes.append(len(rows))
                lefts.append(to_left)
                rights.append(right)
                held += len(rows)
            if held > batch:
                yield np.concatenate(members), np.array(sizes), np.array(lefts), np.array(rights)
                members, sizes, lefts, rights, held = [], [], [], [], 0
        if members:
            yield np.concatenate(members), np.array(sizes), np.array(lefts), np.array(rights)

    def _left_lcp(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = self.left[a] != self.left[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1]) if len(a) else np.empty(0, np.int64)
        return np.minimum(first, np.minimum(self.n_left[a], self.n_left[b]))

    def _by_left(self, rows: np.ndarray, right: int) -> Iterator[tuple[np.ndarray, int]]:
        """The members of a right interval, split wherever the bytes to their left differ, with the bytes they share there."""
        least = self.min_bytes - right
        rows = rows[_sorted(self.left[rows])] if len(rows) > 2 else rows
        lcp = self._left_lcp(rows[1:], rows[:-1])
        if least <= 0:
            # even with nothing to the left: all members are one repeat, besides those that share more
            common = int(lcp.min())
            yield rows, common
            least = common + 1
        for begin, end, size in intervals([0, *lcp.tolist()], least):
            yield rows[begin:end], size


def _distinct(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each occurrence once, though it is met from several of a passage's anchors; by document and place."""
    order = np.lexsort((firsts, ends, starts, doc))
    rows = np.stack([x[order] for x in (doc, starts, ends, firsts)])
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
    return tuple(rows[:, new])


def _unions(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of a document that overlap or touch, made one."""
    order = np.lexsort((starts, doc))
    doc, starts, ends = doc[order], starts[order], ends[order]
    # running end within each document: documents are kept apart by a large step
    step = int(ends.max(initial=0)) + 2
    rank = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) if len(doc) else doc
    reach = np.maximum.accumulate(ends + rank * step)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = starts[1:] + rank[1:] * step > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1 if len(at) else at
    return doc[at], starts[at], reach[last] - rank[last] * step, firsts[:len(at)]


def compressed(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(key, cls, blob): texts for a shuffle, each compressed."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in parts:
            for first, end, texts in batches_of_texts(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([text_key(t) for t in texts], pa.binary()),
                     pa.array([squeeze.compress(t) for t in texts], pa.binary())], names=["key", "cls", "blob"])

    return docs.select(_key(id_col).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(pack, "key long, cls binary, blob binary")


def _key(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))


def maximal_repeats(docs: DataFrame, *, min_bytes: int = 50, text: str = "text", id_col: str = "doc_id",
                    classes: DataFrame | None = None, covered_only: bool = False) -> DataFrame:
    """(cls, key, starts, ends, firsts): the first copy of each text with its occurrences of maximal repeats.

    ``firsts``: the least key of each repeat's members; the repeat is told apart
    by the bytes that it covers. Repeats longer than the context come in pieces
    that overlap. ``covered_only``: (cls, starts, ends) without the members of
    least key.
    """
    classes = classes if classes is not None else text_classes(docs, text, id_col)
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    shards = max(12, -(-size // SHARD_BYTES))
    side = min_bytes - K
    features = lambda texts: [(text_key(t), np.unique(anchors(t, min_bytes)[1])) for t in texts]
    shared = shared_ngrams(docs, features, shards, text, id_col)
    flagged = shared.groupBy("cls").agg(F.flatten(F.collect_list("h")).alias("h")).join(classes, "cls")
    held = compressed(docs, text, id_col).join(flagged, ["cls", "key"]).select("cls", "key", "blob", "h")

    def contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        found, size = [], 0
        for batch in parts:
            for cls, key, blob, h in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
                plain = unpack.decompress(blob, max_output_size=1 << 31)
                places, hashes = anchors(plain, min_bytes)
                wanted, names = np.sort(h.values.to_numpy().view(np.uint64)), names_of(hashes, shards)
                mine = wanted[np.minimum(np.searchsorted(wanted, names), len(wanted) - 1)] == names
                places, hashes = places[mine], hashes[mine]
                padded = np.frombuffer(bytes(side) + plain + bytes(min_bytes), np.uint8)
                around = padded[places[:, None] + np.arange(side + min_bytes)] if len(places) else np.empty((0, side + min_bytes), np.uint8)
                found.append((cls, key, places, hashes, around, len(plain)))
                size += around.size
                if size > FLUSH:
                    yield send(found)
                    found, size = [], 0
        if found:
            yield send(found)

    def send(found: list) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3)
        lengths = [len(x[2]) for x in found]
        owner, places, hashes = np.repeat(np.arange(len(found)), lengths), np.concatenate([x[2] for x in found]), np.concatenate([x[3] for x in found])
        around, total = np.concatenate([x[4] for x in found]), np.repeat([x[5] for x in found], lengths)
        keys, cls = np.array([x[1] for x in found], np.int64), np.frombuffer(b"".join(x[0] for x in found), "V16")
        part = fragment_of(hashes, shards)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(shards + 1))
        rows = []
        for f in range(shards):
            at = order[edges[f]:edges[f + 1]]
            if len(at):
                own, mine = np.unique(owner[at], return_inverse=True)
                rows.append({"f": f, "cls": cls[own].tobytes(), "keys": keys[own].tobytes(), "owner": squeeze.compress(mine.astype(np.int32).tobytes()),
                             "places": squeeze.compress(places[at].astype(np.int64).tobytes()), "totals": squeeze.compress(total[at].astype(np.int64).tobytes()),
                             "around": squeeze.compress(around[at].tobytes())})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("f", pa.int32())] + [(c, pa.binary()) for c in columns]))

    columns = ("cls", "keys", "owner", "places", "totals", "around")

    def scan(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        raw = {c: table.column(c).to_pylist() for c in columns if c != "around"}
        plain = lambda c: [unpack.decompress(x, max_output_size=1 << 31) for x in raw[c]]
        whole = lambda chunks, kind: np.frombuffer(b"".join(chunks), kind)
        cls, keys = whole(raw["cls"], "V16"), whole(raw["keys"], "i8")
        owners, before = [], 0
        for chunk, names in zip(plain("owner"), raw["cls"]):
            owners.append(np.frombuffer(chunk, np.int32) + before)
            before += len(names) // 16
        owner = np.concatenate(owners)
        places, totals = whole(plain("places"), "i8"), whole(plain("totals"), "i8")
        left, right, at = np.empty((len(places), side), np.uint8), np.empty((len(places), min_bytes), np.uint8), 0
        for chunk in table.column("around"):
            around = np.frombuffer(unpack.decompress(chunk.as_buffer(), max_output_size=1 << 31), np.uint8).reshape(-1, side + min_bytes)
            left[at:at + len(around)], right[at:at + len(around)] = around[:, :side][:, ::-1], around[:, side:]
            at += len(around)
        shard = Shard(right, np.minimum(min_bytes, totals - places), left, np.minimum(side, places), min_bytes)
        merge = _unions if covered_only else _distinct
        found, held, most = [], 0, MERGE_AT
        for members, sizes, to_left, to_right in shard.groups():
            if not len(sizes):
                continue
            begins = np.cumsum(sizes) - sizes
            key = keys[owner[members]]
            first = np.repeat(np.minimum.reduceat(key, begins), sizes)
            last = np.repeat(np.maximum.reduceat(key, begins), sizes)
            wanted = first < (key if covered_only else last)  # never what a single document repeats
            spans = (owner[members][wanted], (places[members] - np.repeat(to_left, sizes))[wanted],
                     (places[members] + np.repeat(to_right, sizes))[wanted], first[wanted])
            found.append(merge(*spans))
            held += len(found[-1][0])
            if held > most:  # intervals within intervals cover the same bytes again and again
                found = [merge(*(np.concatenate(x) for x in zip(*found)))]
                held = len(found[0][0])
                most = 2 * held + MERGE_AT
        if not found:
            return out_schema.empty_table()
        doc, starts, ends, firsts = merge(*(np.concatenate(x) for x in zip(*found)))
        own, counts = np.unique(doc, return_counts=True)
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        names = pa.array([cls[i].tobytes() for i in own], pa.binary())
        if covered_only:  # a text has less than 2^31 bytes
            return pa.Table.from_arrays([names, *[pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (starts, ends)]], schema=out_schema)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (starts, ends, firsts)]
        return pa.Table.from_arrays([names, pa.array(keys[own]), *lists], schema=out_schema)

    kind = "cls binary, starts array<int>, ends array<int>" if covered_only else (
        "cls binary, key long, starts array<long>, ends array<long>, firsts array<long>")
    out_schema = pa.schema([("cls", pa.binary()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]) if covered_only else pa.schema(
        [("cls", pa.binary()), ("key", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("starts", "ends", "firsts")]])
    sent = held.mapInArrow(contexts, "f int, " + ", ".join(f"{c} binary" for c in columns))
    return sent.groupBy("f").applyInArrow(scan, kind)


def text_classes(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(cls, key): the least key of each distinct text."""
    return (docs.select(F.unhex(F.md5(_bytes(text))).alias("cls"), _key(id_col).alias("key"))
            .groupBy("cls").agg(F.min("key").alias("key")))


def _bytes(text: str):
    return F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))


def covered_spans(docs: DataFrame, classes: DataFrame, *, min_bytes: int, text: str, id_col: str) -> DataFrame:
    """(cls, key, starts, ends): what repeats cover in the first copy of each text, smaller documents having them too."""
    found = maximal_repeats(docs, min_bytes=min_bytes, text=text, id_col=id_col, classes=classes, covered_only=True)
    covered = found.groupBy("cls").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    covered = covered.join(classes, "cls").select("cls", "key", "starts", "ends")
    return materialize(covered, "repeat-covered")


def _gone(n: int, starts: pa.Array, ends: pa.Array) -> np.ndarray:
    """Which of n bytes the spans cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts.to_numpy(), 1)
    np.add.at(change, ends.to_numpy(), -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(docs: DataFrame, *, min_bytes: int = 50, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with the removed bytes cut out of their text, and of a character cut in half the rest.

    A text of which nothing but white space is left, though something was, is
    dropped; a null text stays null.
    """
    classes = materialize(text_classes(docs, text, id_col), "repeat-classes")
    covered = covered_spans(docs, classes, min_bytes=min_bytes, text=text, id_col=id_col)
    marked = docs.withColumns({"_cls": F.unhex(F.md5(_bytes(text))), "_key": _key(id_col)})
    names = [f"_{i}" for i in range(4)]
    spans = covered.toDF(*names)
    first = classes.toDF("_c", "_first")
    joined = (marked.join(spans, (F.col("_cls") == F.col("_0")) & (F.col("_key") == F.col("_1")), "left")
              .join(first, F.col("_cls") == F.col("_c"))
              .where((F.col("_key") == F.col("_first")) | (F.length(_bytes(text)) < min_bytes)))
    at = joined.columns.index(text)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts, starts, ends = batch.column(at), batch.column(width), batch.column(width + 1)
            out, keep = [], []
            for value, a, b in zip(texts, starts, ends):
                plain = value.as_py()
                if a.is_valid:
                    data = np.frombuffer(plain.encode(), np.uint8)
                    plain = data[~_gone(len(data), a.values, b.values)].tobytes().decode("utf-8", "ignore")
                out.append(plain)
                keep.append(not a.is_valid or bool(plain.strip()))
            columns = [batch.column(i) if i != at else pa.array(out, texts.type) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width]).filter(pa.array(keep))

    width = len(docs.columns)
    return joined.select(*docs.columns, "_2", "_3").mapInArrow(cut, docs.schema)


def remove_repeats(docs: DataFrame, *, min_bytes: int = 50, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document.

    Removed: each byte within a ``min_bytes`` string that also starts in a
    document of smaller id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(id_col).alias("key"), F.unhex(F.md5(_bytes(text))).alias("cls"),
                       F.length(_bytes(text)).cast("long").alias("n_bytes"), F.sha2(_bytes(text), 256).alias("sha"))
    rows = materialize(rows, "repeat-rows")
    classes = materialize(rows.groupBy("cls").agg(F.min("key").alias("key")), "repeat-classes")
    covered = covered_spans(docs, classes, min_bytes=min_bytes, text=text, id_col=id_col)
    schema = pa.schema([("cls", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in parts:
            out = []
            for cls, blob, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                plain = np.frombuffer(unpack.decompress(blob, max_output_size=1 << 31), np.uint8)
                gone = _gone(len(plain), starts.values, ends.values)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append({"cls": cls, "n_removed": int(gone.sum()), "n_spans": spans,
                            "kept_sha256": hashlib.sha256(plain[~gone].tobytes()).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    results = (compressed(docs, text, id_col).join(covered, ["cls", "key"]).dropDuplicates(["cls", "key"]).select("cls", "blob", "starts", "ends")
               .mapInArrow(cut, "cls binary, n_removed long, n_spans long, kept_sha256 string"))
    copy = (F.col("key") > F.col("first")) & (F.col("n_bytes") >= min_bytes)
    own = F.col("key") == F.col("first")
    pick = lambda whole, mine, else_: F.when(copy, whole).when(own, F.coalesce(mine, else_)).otherwise(else_)
    return rows.join(classes.withColumnRenamed("key", "first"), "cls").join(results, "cls", "left").select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"))
