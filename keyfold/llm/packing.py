"""Pack token sequences into windows of several context sizes.

1. Every document is tokenized once, where its text lies. Its ids are cut into
   full windows of the longest context; the rest (shorter than that) stays one
   piece. From here on only piece rows (lengths, checksums) move.
2. Pieces are routed to tiers by length (512, 1024, 2048, 4096). The plan needs
   only how many pieces there are of each length, at most 4096 numbers:
   - the longest tier's windows begin with its own pieces, longest first, and
     their gaps are filled from the shorter tiers: an exact fit if there is
     one, else two pieces that fit exactly, else the longest that fits;
   - shorter tiers form windows of their own size where two pieces fill one
     exactly, so that it needs no padding;
   - what is left is packed into longest windows in the same way.
   A plan step places equally long pieces into equally filled windows, any
   number of them at a time, so the plan's size follows the window, not the data.
3. Each piece gets its number among those of its length (running totals in
   hashed pieces, so a length shared by a third of all documents is no hot key)
   and looks up its place in the plan, which is broadcast: its rows are bounded
   by the window size.
4. Within a tier, sequences ordered by attention cost (sum of squared piece
   lengths) are dealt to steps forth and back, so that steps cost about the same.

Cases: a null or empty text has one token, the end id; repeated rows and null
ids are packed row by row; texts of any length are cut; an empty table gives an
empty result; only the named key columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import materialize, pieces, running_total

TIERS = (512, 1024, 2048, 4096)
ROWS_PER_PIECE = 20_000


def cut(docs: DataFrame, vocabulary: str, *, text: str = "text", key: str = "doc_id", window: int = 4096,
        end_id: int = 2) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), one row per piece."""

    def tokenize(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from keyfold.llm.tokens import word_ids

        encoder = word_ids(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in parts:
            doc, start, length, crc, total = [], [], [], [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(value.as_py() or b"") + end
                n = len(ids) // 4
                for at in range(0, n, window):
                    piece = ids[4 * at:4 * (at + window)]
                    doc.append(name)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("t"))
    return texts.mapInArrow(tokenize, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


@dataclass
class Group:
    """``count`` windows of ``size``, each with one piece per entry of ``held``: (length, first number)."""

    count: int
    size: int
    held: list[tuple[int, int]] = field(default_factory=list)

    @property
    def gap(self) -> int:
        return self.size - sum(n for n, _ in self.held)

    @property
    def cost(self) -> int:
        return sum(n * n for n, _ in self.held)

    def split(self, count: int) -> Group:
        """Keep the first ``count`` windows, return the others."""
        rest = Group(self.count - count, self.size, [(n, first + count) for n, first in self.held])
        self.count = count
        return rest


class Plan:
    """Places for ``histogram[length]`` pieces of each length up to the longest window."""

    def __init__(self, histogram: np.ndarray, tiers: Sequence[int] = TIERS):
        self.left, self.used = histogram.copy(), np.zeros_like(histogram)
        self.tiers, self.groups = sorted(tiers), []
        top = self.tiers[-1]
        lengths = range(len(histogram) - 1, 0, -1)
        for n in (n for n in lengths if n > top // 2):
            self._open(n, top)
        for tier in self.tiers[-2::-1]:
            self._exact(tier)
        for n in lengths:
            while self.left[n]:
                self._open(n, top)
        self._order()

    def _take(self, group: Group, n: int) -> Group | None:
        """Put a piece of length n into as many of the group's windows as there are; the other windows, if any."""
        times = 1
        count = min(group.count, int(self.left[n]) // times)
        rest = group.split(count) if count < group.count else None
        group.held.append((n, int(self.used[n])))
        self.used[n] += count
        self.left[n] -= count
        return rest

    def _open(self, n: int, size: int) -> None:
        """Windows that begin with the pieces of length n, filled as far as possible."""
        if not self.left[n]:
            return
        # when the piece fits several times, no more windows than that many pieces need
        fits = size // n
        first = Group(max(1, int(self.left[n]) // fits), size)
        todo = [first]
        self._take(first, n)
        while todo:
            group = todo.pop()
            while n_next := self._choose(group.gap):
                if rest := self._take(group, n_next):
                    todo.append(rest)
            self.groups.append(group)

    def _choose(self, gap: int) -> int:
        """An exact fit, else the longer of two pieces that fit exactly, else the longest piece that fits; 0: none."""
        if gap <= 0:
            return 0
        have = self.left[:min(gap, len(self.left) - 1) + 1]
        if len(have) == gap + 1:
            if have[gap]:
                return gap
            pair = np.flatnonzero((have[1:gap] > 0) & (have[gap - 1:0:-1] > 0))
            for n in (pair[::-1] + 1)[:2]:  # not one piece twice where there is only one
                if 2 * n != gap or have[n] > 1:
                    return int(max(n, gap - n))
        some = np.flatnonzero(have)
        return int(some[-1]) if len(some) and some[-1] else 0

    def _exact(self, tier: int) -> None:
        """Windows of a shorter tier that one or two pieces fill."""
        if tier < len(self.left) and self.left[tier]:
            self._close(tier, (tier,), int(self.left[tier]))
        for n in range(min(tier, len(self.left)) - 1, tier // 2, -1):
            if count := int(min(self.left[n], self.left[tier - n])):
                self._close(tier, (n, tier - n), count)

    def _close(self, size: int, lengths: tuple[int, ...], count: int) -> None:
        group = Group(count, size)
        for n in lengths:
            self._take(group, n)
        self.groups.append(group)

    def _order(self) -> None:
        """Number the windows by tier, then by cost."""
        self.groups.sort(key=lambda g: (g.size, g.cost, g.held))
        self.first, at = [], 0
        self.tier_first, self.tier_count = {}, {}
        for g in self.groups:
            self.tier_first.setdefault(g.size, at)
            self.tier_count[g.size] = self.tier_count.get(g.size, 0) + g.count
            self.first.append(at)
            at += g.count

    def rows(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, first number, end number, first sequence, offset, window size)."""
        out = []
        for group, sequence in zip(self.groups, self.first):
            offset = 0
            for n, first in group.held:
                out.append((n, first, first + group.count, sequence, offset, group.size))
                offset += n
        return out


def pack(docs: DataFrame, vocabulary: str, *, text: str = "text", key: str = "doc_id", tiers: Sequence[int] = TIERS,
         end_id: int = 2, step_sequences: int = 64) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step."""
    spark = docs.sparkSession
    cuts = materialize(cut(docs, vocabulary, text=text, key=key, window=max(tiers), end_id=end_id), "pack-pieces")
    counts = cuts.groupBy("length").count().collect()  # at most one row per length up to the window
    histogram = np.zeros(max(tiers) + 1, dtype=np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    plan = Plan(histogram, tiers)
    places = F.broadcast(spark.createDataFrame(
        plan.rows(), "p_length long, p_first long, p_end long, p_sequence long, offset long, context long"))
    numbered = running_total(cuts, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], F.lit(1).cast("long"),
                             "_number", pieces(cuts, ROWS_PER_PIECE))
    placed = numbered.join(places, (F.col("length") == F.col("p_length")) & (F.col("_number") >= F.col("p_first"))
                           & (F.col("_number") < F.col("p_end")))
    sequence = F.col("p_sequence") + F.col("_number") - F.col("p_first")
    step, steps_before = F.lit(0), 0
    for size in sorted(plan.tier_count):
        steps = -(-plan.tier_count[size] // step_sequences)
        at = sequence - plan.tier_first[size]
        along = F.pmod(at, F.lit(steps))
        dealt = F.when(F.floor(at / steps) % 2 == 0, along).otherwise(steps - 1 - along)
        step = F.when(F.col("context") == size, steps_before + dealt).otherwise(step)
        steps_before += steps
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", sequence.alias("sequence_id"), "offset",
                         "context", step.cast("long").alias("step"))
