"""Benchmark decontamination with one FM-index per training shard.

1. ``build_index`` cuts the documents into shards of at most ``shard_words``
   words, wherever Spark has put them (no shuffle). A shard's suffix array is
   sorted by prefix doubling; of it stay the Burrows-Wheeler transform, as a
   wavelet matrix of 4-bit digits with counts every ``BLOCK`` symbols, and the
   places of every ``SAMPLE``-th suffix. The index is a table of its own: other
   phrases can be searched later without the texts.
2. ``find`` searches phrases backwards: the suffix-array range of a phrase's end
   is narrowed word by word, by two ranks a word, for all phrases of a shard at
   once. What occurs is located by walking backwards to the next sampled suffix.
3. Places become spans of words, which are merged per document.

Phrases meet shards in rounds: a round broadcasts at most ``ROUND_BYTES`` of
word hashes (measured before), and there are as many rounds as it takes.

A word is a run of digits, letters and non-ASCII bytes, after lower-casing A-Z;
words are told apart by 64-bit hashes. A document longer than a shard is cut
into pieces that overlap by ``LONGEST`` - 1 words, so no phrase is lost.

Cases: null and empty texts have no words and no hits; repeated rows count each;
a null id is kept; benchmark rows of one id are one item; those of null id hit
words but aren't named or counted; an empty benchmark hits nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import batches_of_texts, materialize
from keyfold.llm.words import word_hashes

#: Symbols of a shard fit so many bits: three of them make one sortable integer.
BITS = 21
#: Words of a shard.
SHARD_WORDS = 1 << 20
#: Symbols between stored counts.
BLOCK = 256
#: Words between sampled suffixes.
SAMPLE = 16
#: Words of the longest phrase that can be searched.
LONGEST = 64
#: Bytes of phrases (8 a word) that one round broadcasts.
ROUND_BYTES = 2 << 20
#: Text that is turned into words at once.
SLICE = 1 << 20

#: Bytes that are no part of a word: ASCII but digits and letters.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[0x80:] = False
for _first, _last in ("09", "az", "AZ"):
    BETWEEN[ord(_first):ord(_last) + 1] = False


def _symbols(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct words, number of each word among them)."""
    n = len(words)
    top = words >> np.uint64(BITS) << np.uint64(BITS)
    packed = np.sort(top | np.arange(n, dtype=np.uint64))  # by the upper bits, with the place in the lower ones
    order = (packed & np.uint64((1 << BITS) - 1)).astype(np.int64)
    ordered = words[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    packed >>= np.uint64(BITS)
    if n and (new[1:] & (packed[1:] == packed[:-1])).any():  # words that only differ below
        known, number = np.unique(words, return_inverse=True)
        return known, number.astype(np.int64)
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Order of all suffixes; ``rank``: symbols below 2^21, the text's end being unique.

    Each round sorts by twice as many symbols; suffixes that are alone in their
    group are done and left out.
    """
    n, low = len(rank), np.int64((1 << BITS) - 1)
    rank, reach = rank.astype(np.int64), 1
    after = np.zeros(n, np.int64)
    after[:-1] = rank[1:]
    keys = np.sort((rank << BITS | after) << BITS | np.arange(n))
    suffixes, group = keys & low, keys >> BITS
    begins = np.ones(n, dtype=bool)
    begins[1:] = group[1:] != group[:-1]
    at = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    rank[suffixes] = at
    order = suffixes.copy()
    reach = 2
    while True:
        alone = begins.copy()
        alone[:-1] &= begins[1:]
        open_ = ~alone
        suffixes, at = suffixes[open_], at[open_]
        if not len(suffixes):
            return order
        after = rank[np.minimum(suffixes + reach, n - 1)]
        packed = np.sort((at << BITS | after) << BITS | suffixes)
        suffixes, group = packed & low, packed >> BITS
        at = group >> BITS  # where the old group starts
        size = np.arange(len(at))
        old = np.ones(len(at), dtype=bool)
        old[1:] = at[1:] != at[:-1]
        within = size - np.maximum.accumulate(np.where(old, size, 0))
        order[at + within] = suffixes
        begins = np.ones(len(at), dtype=bool)
        begins[1:] = group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(begins, size, 0))
        at = at + within - (size - first)
        rank[suffixes] = at
        reach *= 2


class FMIndex:
    """The index of one shard: pieces of documents, each followed by a separator (symbol 0)."""

    ARRAYS = {"vocabulary": np.uint64, "shift": np.int32, "digits": np.uint8, "counts": np.uint32, "first": np.int64,
              "rows": np.int32, "places": np.int32, "starts": np.int32}

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)
        self.levels = len(self.first) // 16
        self.n = int(self.starts[-1])
        self.digits = np.frombuffer(self.digits, np.uint8).reshape(self.levels, -1)
        self.counts = self.counts.reshape(self.levels, -1, 16)
        self.first = self.first.reshape(self.levels, 16)
        self.unpacked: np.ndarray | None = None

    @classmethod
    def build(cls, words: np.ndarray, sizes: np.ndarray) -> FMIndex:
        """``words`` of all pieces, ``sizes``: how many each has."""
        pieces = len(sizes)
        vocabulary, number = _symbols(words)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        n = int(starts[-1])
        ends = starts[1:] - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = number + 1
        # separators are told apart by their order, so that no comparison crosses one
        rank = text + pieces - 1
        rank[ends] = np.arange(pieces)
        order = suffix_array(rank)
        before = text[order - 1]  # of the first suffix: the last separator
        counted = np.bincount(text, minlength=len(vocabulary) + 1)
        begin = np.cumsum(counted) - counted
        levels = max(1, -(-int(len(vocabulary)).bit_length() // 4))
        blocks = n // BLOCK + 1
        digits, counts, first = [], [], []
        now = before
        for level in reversed(range(levels)):
            digit = (now >> (4 * level) & 15).astype(np.uint8)
            padded = np.full(blocks * BLOCK, 255, np.uint8)
            padded[:n] = digit
            table = padded.reshape(blocks, BLOCK)
            per_block = np.stack([(table == d).sum(axis=1) for d in range(16)], axis=1)
            upto = np.cumsum(per_block, axis=0)
            counts.append((upto - per_block).astype(np.uint32))
            first.append(np.cumsum(upto[-1]) - upto[-1])
            padded[n:] = 0
            digits.append(padded[0::2] | padded[1::2] << 4)
            now = now[np.argsort(digit, kind="stable")]
        # where a symbol's run begins after the last level; its suffixes lie that much further on
        run = np.zeros(len(counted), np.int64)
        run[now[::-1]] = np.arange(n)[::-1]
        sampled = np.zeros(n, dtype=bool)
        sampled[::SAMPLE] = True
        sampled[starts[:-1]] = True
        rows = np.flatnonzero(sampled[order])
        return cls(vocabulary=vocabulary, shift=begin - run, digits=np.concatenate(digits), counts=np.concatenate(counts).ravel(),
                   first=np.concatenate(first), rows=rows.astype(np.int32), places=order[rows].astype(np.int32), starts=starts.astype(np.int32))

    def columns(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.ARRAYS.items()}

    @classmethod
    def of(cls, columns: dict[str, bytes]) -> FMIndex:
        return cls(**{name: np.frombuffer(columns[name], kind) for name, kind in cls.ARRAYS.items()})

    def _level(self, level: int) -> np.ndarray:
        if self.unpacked is None:
            self.unpacked = np.empty((self.levels, self.digits.shape[1] * 2), np.uint8)
            self.unpacked[:, 0::2] = self.digits & 15
            self.unpacked[:, 1::2] = self.digits >> 4
        return self.unpacked[level]

    def _rank(self, level: int, digit: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the digit occurs before each place."""
        block, rest = at // BLOCK, at % BLOCK
        out = self.counts[level, block, digit].astype(np.int64)
        table = self._level(level).reshape(-1, BLOCK)
        for a in range(0, len(at), 1 << 14):
            part = slice(a, a + (1 << 14))
            same = table[block[part]] == digit[part, None].astype(np.uint8)
            out[part] += (same & (np.arange(BLOCK) < rest[part, None])).sum(axis=1)
        return out

    def _down(self, level: int, digit: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[level, digit] + self._rank(level, digit, at)

    def symbols_of(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; 0: not in this shard."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    def ranges(self, ends: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases that occur: those that end before place ``ends`` of ``symbols``."""
        alive = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        ready = []
        step = 0
        while len(alive):
            step += 1
            symbol = symbols[ends[alive] - step]
            there = symbol > 0
            alive, low, high, symbol = alive[there], low[there], high[there], symbol[there]
            # many phrases ask the same at first: each question is answered once
            asked, which = np.unique(np.concatenate((symbol << (BITS + 1) | low, symbol << (BITS + 1) | high)), return_inverse=True)
            symbol, at = asked >> (BITS + 1), asked & ((1 << (BITS + 1)) - 1)
            for level in range(self.levels):
                at = self._down(level, symbol >> (4 * (self.levels - 1 - level)) & 15, at)
            at = (at + self.shift[symbol])[which]
            low, high = at[:len(alive)], at[len(alive):]
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
            over = lengths[alive] == step
            ready.append((alive[over], low[over], high[over]))
            alive, low, high = alive[~over], low[~over], high[~over]
        if not ready:
            return alive, low, high
        return tuple(np.concatenate(x) for x in zip(*ready))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of rows of the suffix array."""
        out = np.empty(len(rows), np.int64)
        left, rows, step = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(left):
            at = np.minimum(np.searchsorted(self.rows, rows), len(self.rows) - 1)
            known = self.rows[at] == rows
            out[left[known]] = self.places[at[known]] + step
            left, rows = left[~known], rows[~known]
            symbol, at = np.zeros(len(rows), np.int64), rows
            for level in range(self.levels):
                digit = self._level(level)[at].astype(np.int64)
                symbol = symbol << 4 | digit
                at = self._down(level, digit, at)
            rows, step = at + self.shift[symbol], step + 1
        return out


def text_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(texts, BETWEEN)


_PIECES = "array<struct<row: long, doc_id: long, cls: binary, base: long, n_words: long>>"


def build_index(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard: its pieces (``n_words`` of the whole document on the first one, else null) and its index."""
    if not LONGEST * 2 <= shard_words <= (1 << BITS) // 2:
        raise ValueError(f"shard_words must lie between {LONGEST * 2} and {(1 << BITS) // 2}")

    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pieces, size, row = [], [], 0, 0
        for batch in parts:
            part = batch.column(0)[0].as_py() if batch.num_rows else 0
            for first, end, texts in batches_of_texts(batch, limit=SLICE):
                words, counts = text_words(texts)
                edges = np.concatenate(([0], np.cumsum(counts)))
                for i, doc_id in enumerate(batch.column(1).slice(first, end - first).to_pylist()):
                    mine = words[edges[i]:edges[i + 1]]
                    name = {"row": part << 40 | row, "doc_id": doc_id, "cls": hashlib.md5(texts[i]).digest()}
                    row += 1
                    for base in range(0, max(1, len(mine)), shard_words - LONGEST):
                        if base and base + LONGEST - 1 >= len(mine):
                            break  # whole within the piece before
                        piece = mine[base:base + shard_words - 1]
                        if size + len(piece) + 1 > shard_words and held:
                            yield send(held, pieces)
                            held, pieces, size = [], [], 0
                        held.append(piece.copy())
                        pieces.append({**name, "base": base, "n_words": None if base else len(mine)})
                        size += len(piece) + 1
        if held:
            yield send(held, pieces)

    def send(held: list[np.ndarray], pieces: list[dict]) -> pa.RecordBatch:
        index = FMIndex.build(np.concatenate(held), np.array([len(x) for x in held]))
        return pa.RecordBatch.from_pylist([{"pieces": pieces, **index.columns()}], schema=schema)

    kind = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("cls", pa.binary()), ("base", pa.int64()), ("n_words", pa.int64())])
    schema = pa.schema([("pieces", pa.list_(kind)), *[(name, pa.binary()) for name in FMIndex.ARRAYS]])
    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(shards, f"pieces {_PIECES}, " + ", ".join(f"{name} binary" for name in FMIndex.ARRAYS))


class Phrases:
    """Windows of items: distinct ones, each with the items that it comes from."""

    def __init__(self, items: list[str | None], words: list[bytes], window: int):
        self.names = sorted({x for x in items if x is not None})
        number = {name: i for i, name in enumerate(self.names)}
        parts = [np.frombuffer(x, np.uint64) for x in words]
        self.words, self.numbers = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_inverse=True)
        seen: dict[bytes, int] = {}
        ends, lengths, pairs, at = [], [], set(), 0
        for item, part in zip(items, parts):
            size = min(window, len(part))
            mine = self.numbers[at:at + len(part)].astype(np.int32)
            for i in range(len(part) - size + 1 if size else 0):
                phrase = seen.setdefault(mine[i:i + size].tobytes(), len(seen))
                if phrase == len(ends):
                    ends.append(at + i + size)
                    lengths.append(size)
                if item is not None:
                    pairs.add((phrase, number[item]))
            at += len(part)
        self.ends, self.lengths = np.array(ends, np.int64), np.array(lengths, np.int64)
        ordered = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.items = ordered[:, 1]
        self.edges = np.searchsorted(ordered[:, 0], np.arange(len(ends) + 1))

    def within(self, index: FMIndex) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of all occurrences in a shard."""
        symbols = index.symbols_of(self.words)[self.numbers]
        phrase, low, high = index.ranges(self.ends, self.lengths, symbols)
        many = high - low
        rows = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.repeat(phrase, many), index.locate(rows)


def _merged(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a piece that overlap or touch, made one; by piece and place."""
    order = np.lexsort((starts, piece))
    piece, starts, ends = piece[order], starts[order], ends[order]
    step = int(ends.max(initial=0)) + 2
    reach = np.maximum.accumulate(ends + piece * step)
    new = np.ones(len(piece), dtype=bool)
    new[1:] = starts[1:] + piece[1:] * step > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(piece)) - 1
    return piece[at], starts[at], reach[last] - piece[at] * step


def find(index: DataFrame, phrases: DataFrame, *, window: int = 10, text: str = "text", id_col: str = "item_id") -> DataFrame:
    """(row, starts, ends, items) per document with hits: merged spans of words, sorted ids of the items that occur.

    Phrases: all windows of ``window`` words of each text; a shorter text is one window.
    """
    if window > LONGEST:
        raise ValueError(f"windows of more than {LONGEST} words aren't indexed")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, end, texts in batches_of_texts(batch, limit=SLICE):
                words, counts = text_words(texts)
                edges = np.concatenate(([0], np.cumsum(counts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     pa.array([words[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())], names=["item", "words"])

    spark = index.sparkSession
    asked = phrases.select(F.col(id_col).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    asked = materialize(asked.mapInArrow(cut, "item string, words binary").where("length(words) > 0").distinct(), "phrases")
    size = asked.agg(F.sum(F.length("words"))).first()[0] or 0
    rounds = -(-size // ROUND_BYTES)
    found = None
    for turn in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("item", "words"), F.lit(rounds)) == turn).toArrow()
        sent = spark.sparkContext.broadcast(Phrases(rows.column(0).to_pylist(), rows.column(1).to_pylist(), window))
        here = index.mapInArrow(_searcher(sent), "row long, starts array<long>, ends array<long>, items array<string>")
        found = here if found is None else found.unionByName(here)
    if found is None:
        return spark.createDataFrame([], "row long, starts array<long>, ends array<long>, items array<string>")
    together = found.groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # spans of several pieces or rounds may overlap
    joined = F.aggregate("spans", F.slice("spans", 1, 1), lambda done, span: F.when(
        span["starts"] > F.element_at(done, -1)["ends"], F.concat(done, F.array(span))).otherwise(
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["starts"].alias("starts"), F.greatest(F.element_at(done, -1)["ends"], span["ends"]).alias("ends"))))))
    return together.withColumn("spans", joined).select("row", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items")


def _searcher(sent):
    schema = pa.schema([("row", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for batch in parts:
            for shard in batch.to_pylist():
                index = FMIndex.of(shard)
                phrase, place = phrases.within(index)
                if not len(phrase):
                    continue
                rows = np.array([p["row"] for p in shard["pieces"]])
                base = np.array([p["base"] for p in shard["pieces"]])
                piece = np.searchsorted(index.starts, place, side="right") - 1
                start = place - index.starts[piece] + base[piece]
                pieces, starts, ends = _merged(piece, start, start + phrases.lengths[phrase])
                pairs = np.unique(piece * len(phrases.lengths) + phrase)
                owner, which = pairs // len(phrases.lengths), pairs % len(phrases.lengths)
                out = []
                edges = np.flatnonzero(np.concatenate(([True], pieces[1:] != pieces[:-1], [True])))
                for a, b in zip(edges[:-1], edges[1:]):
                    mine = which[np.searchsorted(owner, pieces[a]):np.searchsorted(owner, pieces[a], side="right")]
                    items = {int(i) for p in mine for i in phrases.items[phrases.edges[p]:phrases.edges[p + 1]]}
                    out.append({"row": int(rows[pieces[a]]), "starts": starts[a:b].tolist(), "ends": ends[a:b].tolist(),
                                "items": [phrases.names[i] for i in sorted(items)]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return search


def hits(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text: str = "text", id_col: str = "doc_id",
         item_col: str = "item_id", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(row, doc_id, cls, n_words, starts, ends, items) of every document; arrays are empty without a hit. ``cls``: MD5 of the text."""
    index = materialize(build_index(docs, text=text, id_col=id_col, shard_words=shard_words), "fm-index")
    found = find(index.select("pieces", *FMIndex.ARRAYS), benchmark, window=window, text=text, id_col=item_col)
    rows = index.select(F.explode("pieces").alias("p")).select("p.*").where("n_words is not null").drop("base")
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return rows.join(found, "row", "left").select(
        "row", "doc_id", "cls", "n_words", F.coalesce("starts", empty("long")).alias("starts"),
        F.coalesce("ends", empty("long")).alias("ends"), F.coalesce("items", empty("string")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda total, x: total + x)
    return hits(docs, benchmark, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents with each merged span cut out of the text, from its first word to its last; a null text stays null."""
    spans = hits(docs, benchmark, text=text, **options).where("size(starts) > 0").dropDuplicates(["cls"])
    marked = docs.withColumn("_cls", F.unhex(F.md5(F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b"")))))
    joined = marked.join(spans.select(F.col("cls").alias("_c"), F.col("starts").alias("_starts"), F.col("ends").alias("_ends")),
                         F.col("_cls") == F.col("_c"), "left").select(*docs.columns, "_starts", "_ends")
    at, width = docs.columns.index(text), len(docs.columns)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out = []
            for value, a, b in zip(batch.column(at), batch.column(width), batch.column(width + 1)):
                plain = value.as_py()
                if a.is_valid:
                    data = plain.encode()
                    word = ~BETWEEN[np.frombuffer(data, np.uint8)]
                    edge = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
                    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    kept, upto = [], 0
                    for x, y in zip(a.as_py(), b.as_py()):
                        kept.append(data[upto:begins[x]])
                        upto = ends[y - 1]
                    plain = b"".join([*kept, data[upto:]]).decode()
                out.append(plain)
            columns = [batch.column(i) if i != at else pa.array(out, batch.column(at).type) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    return joined.mapInArrow(cut, docs.schema)
