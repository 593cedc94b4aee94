"""Which files of a snapshot a read has to open (C4, L4, M1).

When a snapshot has been written, one column-pruned pass over it writes

* a zone map: per file its rows, size, the least and largest value and the NULLs
  of each indexed column, and the least and largest z-value;
* the quantile bounds that the z-values were made with;
* a Bloom filter of the keys per file.

A box query (ranges of columns) is split into ranges of z-values; a file is read
if its zones meet the box and its z-values one of these ranges. A set of keys
is looked up in the filters. Both choose files by expressions over one row per
file, before any footer is opened.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators import layout

#: Bits that a filter has per row, and how many of them a key sets: about 1 % of other keys pass.
BLOOM_BITS, BLOOM_HASHES = 10, 7
#: Ranges that a box is split into at most; what is left undivided is searched whole.
MAX_RANGES = 256
#: Keys that are looked up in the filters; with more, every file is taken to be touched.
MAX_PROBED_KEYS = 100_000

Box = Mapping[str, tuple[Any, Any]]


# ------------------------------------------------------------------ z-ranges


def z_ranges(lows: Sequence[int], highs: Sequence[int], bits: int, limit: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Ranges of z-values that cover the box of buckets ``lows`` to ``highs`` (inclusive); disjoint, in order.

    Cells of the z-curve are halved, the largest first, as long as they lie
    partly outside and there are less than ``limit``; so the ranges never miss a
    bucket, and few are too wide.
    """
    n = len(lows)
    top = bits * n

    def place(first: Sequence[int], last: Sequence[int]) -> int:
        """-1: outside the box, 1: within, 0: both."""
        if any(b < lo or a > hi for a, b, lo, hi in zip(first, last, lows, highs)):
            return -1
        return int(all(a >= lo and b <= hi for a, b, lo, hi in zip(first, last, lows, highs)))

    whole = ((0,) * n, ((1 << bits) - 1,) * n)
    where = place(*whole)
    done = [(0, (1 << top) - 1)] if where == 1 else []
    open_ = [(-top, 0, *whole)] if where == 0 else []  # the largest cell first
    while open_ and len(open_) + len(done) < limit:
        size, begin, first, last = heapq.heappop(open_)
        bit, j = divmod(-size - 1, n)
        half = 1 << bit
        low = (first, tuple(x - half if i == j else x for i, x in enumerate(last)))
        high = (tuple(x + half if i == j else x for i, x in enumerate(first)), last)
        for start, cell in ((begin, low), (begin + (1 << (-size - 1)), high)):
            where = place(*cell)
            if where == 1:
                done.append((start, start + (1 << (-size - 1)) - 1))
            elif where == 0:
                heapq.heappush(open_, (size + 1, start, *cell))
    done += [(begin, begin + (1 << -size) - 1) for size, begin, *_ in open_]
    out: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


# ------------------------------------------------------------------ building


def _bloom_places(keys: Sequence[Column], n_bits: int) -> list[Column]:
    """The bits that a key sets: two hashes, stepped."""
    a, b = F.xxhash64(F.lit(1), *keys), F.xxhash64(F.lit(2), *keys)
    # the second hash is made odd, and both are kept small, so that no product leaves 64 bits
    a, b = F.pmod(a, F.lit(n_bits)), F.pmod(b, F.lit(n_bits)).bitwiseOR(F.lit(1))
    return [F.pmod(a + b * i, F.lit(n_bits)) for i in range(BLOOM_HASHES)]


def bloom_bits(rows: int, files: int) -> int:
    """Bits of each filter: of all files alike, for the mean number of rows, in whole words."""
    return max(64, 64 * math.ceil(BLOOM_BITS * rows / max(1, files) / 64))


def _with_file(snapshot: DataFrame) -> DataFrame:
    return snapshot.withColumns({"_file": F.col("_metadata.file_path"), "_bytes": F.col("_metadata.file_size")})


def zone_map(snapshot: DataFrame, columns: Sequence[str], *, zorder_by: Sequence[str] = (), bounds: Sequence[list] | None = None,
             bits: int = 0) -> DataFrame:
    """(file, bytes, rows, zmin, zmax, min_<c>, max_<c>, nulls_<c>) of a frame that scans files."""
    rows = _with_file(snapshot.select(*[F.col(f"`{c}`") for c in columns], "_metadata"))
    if bounds:
        rows = layout.zordered(rows, zorder_by, bounds, bits)
    else:
        rows = rows.withColumn("_z", F.lit(None).cast("long"))
    per_column = [agg for c in columns for agg in (
        F.min(f"`{c}`").alias(f"min_{c}"), F.max(f"`{c}`").alias(f"max_{c}"), F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}"))]
    return rows.groupBy(F.col("_file").alias("file")).agg(
        F.max("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("_z").alias("zmin"), F.max("_z").alias("zmax"), *per_column)


def bloom_filters(snapshot: DataFrame, key: Sequence[str], n_bits: int) -> DataFrame:
    """(file, n_bits, words): each file's filter, its words in order.

    A task ORs the bits of its own files first; a word per file and 64 bits is
    what goes through the shuffle.
    """
    names = [F.col(f"`{c}`") for c in key]
    rows = _with_file(snapshot.select(*names, "_metadata"))
    place = F.explode(F.array(*_bloom_places(names, n_bits)))
    words = (rows.select("_file", place.alias("p")).groupBy(F.col("_file").alias("file"), F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")))
    held = words.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("held"))
    # in one walk over the words that hold a bit: the zeros before each, then those after the last
    zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n.cast("int"))
    filled = F.flatten(F.transform("held", lambda x, i: F.concat(
        zeros(x["w"] - F.when(i > 0, F.get("held", i - 1)["w"]).otherwise(-1) - 1), F.array(x["bits"]))))
    every = F.concat(filled, zeros(F.lit(n_bits // 64 - 1) - F.element_at("held", -1)["w"]))
    return held.select("file", F.lit(n_bits).alias("n_bits"), every.alias("words"))


# ------------------------------------------------------------------ choosing


def in_box(box: Box) -> Column:
    """Whether a row lies in the box; a limit of None is open, NULL values never do."""
    test = F.lit(True)
    for c, (lo, hi) in box.items():
        value = F.col(f"`{c}`")
        test = test & value.isNotNull()
        test = test if lo is None else test & (value >= F.lit(lo))
        test = test if hi is None else test & (value <= F.lit(hi))
    return F.coalesce(test, F.lit(False))


def meets_box(box: Box, indexed: Sequence[str]) -> Column:
    """Whether a file's zones leave room for a row of the box."""
    test = F.lit(True)
    for c, (lo, hi) in box.items():
        if c in indexed:
            test = test & (F.col("rows") > F.col(f"nulls_{c}"))
            test = test if lo is None else test & (F.col(f"max_{c}") >= F.lit(lo))
            test = test if hi is None else test & (F.col(f"min_{c}") <= F.lit(hi))
    return F.coalesce(test, F.lit(False))


def box_ranges(spark: SparkSession, box: Box, schema, zorder_by: Sequence[str], bounds: Sequence[list], bits: int) -> list[tuple[int, int]]:
    """The box as ranges of z-values: its limits as bucket numbers (one small query), then split."""
    picked = []
    for c, column_bounds in zip(zorder_by, bounds):
        for i, limit in enumerate(box.get(c, (None, None))):
            if limit is None:
                picked.append(F.lit(0 if i == 0 else (1 << bits) - 1).cast("long"))
            else:
                one = spark.range(1).select(F.lit(limit).cast(schema[c].dataType).alias(c))
                picked.append(F.lit(one.select(F.expr(layout._bucket_sql(layout._ranked_sql(one, c), column_bounds))).first()[0]))
    values = list(spark.range(1).select(*[p.alias(f"p{i}") for i, p in enumerate(picked)]).first())
    return z_ranges(values[0::2], values[1::2], bits)


def meets_ranges(ranges: Sequence[tuple[int, int]]) -> Column:
    if not ranges:
        return F.lit(False)
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in ranges])
    return F.exists(pairs, lambda r: (F.col("zmin") <= r["b"]) & (F.col("zmax") >= r["a"]))


def holds_a_key(keys: DataFrame, key: Sequence[str], filters: DataFrame) -> DataFrame:
    """(file) of the filters that some key passes. ``keys``: at most ``MAX_PROBED_KEYS`` (the caller knows)."""
    n_bits = filters.agg(F.max("n_bits")).first()[0]
    if n_bits is None:
        return filters.select("file")
    asked = keys.select(F.array(*_bloom_places([F.col(f"`{c}`") for c in key], n_bits)).alias("p"))
    asked = asked.agg(F.collect_set("p").alias("asked"))  # bounded: one value, which every filter is tested with
    bit = lambda p: F.call_function("getbit", F.element_at("words", (F.shiftright(p, 6) + 1).cast("int")), (p % 64).cast("int")) == 1
    return filters.withColumn("asked", asked.scalar()).where(F.exists("asked", lambda k: F.forall(k, bit))).select("file")
