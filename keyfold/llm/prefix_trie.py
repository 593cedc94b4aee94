"""A trie of conversation prefixes, with subtree totals by parallel tree contraction.

1. A turn becomes the MD5 of its role and text, once, where it is read. Turns are
   put in order by a range partitioning on (conversation, turn), so a hot
   conversation spans several pieces; what a row needs from the pieces before
   its own (how many turns, which hash) comes from one small row per
   conversation and piece.
2. A prefix is named by its length and by the exclusive or of two 64-bit hashes
   of (place, turn): a running aggregate. Taking a turn's own hashes out again
   names its parent. Equal names make a node.
3. ``subtree_sums`` contracts the tree in join rounds. Rake: leaves hand their
   totals to their parents. Compress: nodes with a single child are spliced out
   of their chains, those whose depth is divisible by a smaller power of two
   before their neighbours, so that a chain halves. Spliced nodes remember the
   child that they wait for and what is to be added; when all is contracted, the
   rounds are gone through backwards and each gets its total. All joins are
   one to one, besides children looking up their parent's id once.

Cases: rows of null conversation take no part; null role or text is empty; turns
of null number come first, equal numbers are ordered by the MD5; repeated rows
are turns of their own; a conversation whose rebuilt form has no turn ends at
the root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import materialize

#: Rows of a piece of the order.
ROWS_PER_PIECE = 500_000
#: Bytes of joined ids that go on as one row.
CHUNK = 1 << 16


def _n_pieces(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PIECE))


# ---------------------------------------------------------------- conversations


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(c, piece, turn, key, n_bytes, rid): turns without their text; each piece is a stretch of the order."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.md5(F.concat(F.md5(role), text)).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("rid")).where("c is not null")
    n = _n_pieces(conversations, conversations.count())
    dealt = rows.repartitionByRange(n, F.col("c"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("rid"))
    return materialize(dealt.withColumn("piece", F.spark_partition_id()), "trie-turns")


def rebuilt(conversations: DataFrame, *, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): each conversation c with its first turns taken from conversation c - c % ``every``.

    How many: the CRC-32 of c in decimal, modulo ``most``. ``turns``: (c, piece, depth,
    key, n_bytes, last); ``convs``: (c, length).
    """
    turns = ordered_turns(conversations)
    per_piece = materialize(turns.groupBy("c", "piece").agg(F.count("*").alias("n")), "trie-pieces")
    convs = per_piece.groupBy("c").agg(F.sum("n").alias("n")).withColumns({
        "h": F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most)), "b": F.col("c") - F.col("c") % every})
    bases = convs.select(F.col("c").alias("b"), F.col("n").alias("n_b"))
    convs = convs.join(bases, "b", "left").withColumn("head", F.least("h", F.coalesce("n_b", F.lit(0))))
    convs = materialize(convs.select("c", "b", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    before = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    frames = (per_piece.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .join(convs, "c").select("c", "piece", "base", "h", "head", "length"))
    inside = Window.partitionBy("c", "piece").orderBy(F.col("turn").asc_nulls_first(), "key", "rid")
    placed = turns.withColumn("at", F.row_number().over(inside) - 1).join(frames, ["c", "piece"]).withColumn("at", F.col("base") + F.col("at"))
    depth = F.col("head") + F.col("at") - F.col("h") + 1
    own = placed.where("at >= h").select("c", "piece", depth.alias("depth"), "key", "n_bytes", (depth == F.col("length")).alias("last"))
    first = placed.where((F.col("at") < most - 1) & (F.col("c") % every == 0)).select(F.col("c").alias("b"), "at", "key", "n_bytes")
    heads = first.join(convs.where("head > 0"), "b").where("at < head").select(
        "c", F.lit(-1).alias("piece"), (F.col("at") + 1).alias("depth"), "key", "n_bytes", (F.col("at") + 1 == F.col("length")).alias("last"))
    return materialize(own.unionByName(heads), "trie-rebuilt"), convs.select("c", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """(c, depth, a, b, up_a, up_b, n_bytes, last): the prefix that each turn ends, and the one without it."""
    marked = turns.withColumns({x: F.xxhash64(F.lit(i), "depth", "key") for i, x in enumerate(("x", "y"))})
    before = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("c", "piece").agg(F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py")).withColumns(
        {f"before_{x}": F.coalesce(F.bit_xor(f"p{x}").over(before), F.lit(0)) for x in "xy"}).drop("px", "py")
    upto = Window.partitionBy("c", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = marked.withColumns({f"run_{x}": F.bit_xor(x).over(upto) for x in "xy"}).join(carried, ["c", "piece"])
    a, b = (F.col(f"run_{x}").bitwiseXOR(F.col(f"before_{x}")) for x in "xy")
    return running.select("c", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("up_a"),
                          b.bitwiseXOR(F.col("y")).alias("up_b"), "n_bytes", "last")


# ---------------------------------------------------------------- tree contraction


def _sooner(mine: Sequence[Column], other: Sequence[Column]) -> Column:
    return (mine[0] < other[0]) | ((mine[0] == other[0]) & (mine[1] < other[1]))


def subtree_sums(tree: DataFrame, weights: Sequence[str], rounds_taken: list[int] | None = None) -> DataFrame:
    """(id, *weights) summed over each node's subtree, its top included.

    ``tree``: (id, parent, depth, *weights), ids unique, parent null at a root.
    ``rounds_taken`` gets how many nodes were left after each round.
    """
    carry = [f"carry_{w}" for w in weights]
    both = lambda w: F.col(w) + F.col(f"carry_{w}")
    power = F.bit_count(F.col("depth").bitwiseAND(-F.col("depth")) - 1)  # of two that divides the depth
    active = tree.select("id", "parent", power.alias("power"), *weights, *[F.lit(0).cast("long").alias(c) for c in carry])
    known, splices = [], []
    while True:
        kids = active.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.lit(True).alias("inner"))
        flagged = materialize(active.join(kids, "id", "left").withColumn("inner", F.col("inner").isNotNull()), "trie-flagged")
        known.append(flagged.where("not inner").select("id", *weights))
        inner, leaf = F.col("inner"), ~F.col("inner")
        raked = flagged.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            *[F.coalesce(F.sum(F.when(leaf, both(w))), F.lit(0)).alias(f"raked_{w}") for w in weights],
            F.count_if(inner).alias("m"), F.min(F.when(inner, F.col("id"))).alias("only"))
        unary = (F.col("m") == 1) & F.col("parent").isNotNull()
        left = flagged.where("inner").join(raked, "id").select(
            "id", "parent", "power", *[(F.col(w) + F.col(f"raked_{w}")).alias(w) for w in weights], *carry,
            unary.alias("unary"), F.when(unary, F.col("only")).alias("only"))
        left = materialize(left, "trie-raked")
        n = left.count()
        if rounds_taken is not None:
            rounds_taken.append(n)
        if not n:
            break
        above = left.where("unary").select(F.col("only").alias("id"), F.col("power").alias("up_power"), F.col("id").alias("up_id"))
        below = left.select(F.col("id").alias("only"), F.col("unary").alias("down_unary"), F.col("power").alias("down_power"),
                            *[F.col(c).alias(f"down_{c}") for c in carry])
        me = (F.col("power"), F.col("id"))
        spliced = (F.col("unary") & (F.col("up_id").isNull() | _sooner(me, (F.col("up_power"), F.col("up_id"))))
                   & (~F.col("down_unary") | _sooner(me, (F.col("down_power"), F.col("only")))))
        marked = left.join(above, "id", "left").join(below, "only", "left").withColumn(
            "spliced", F.coalesce(spliced, F.lit(False)))
        marked = materialize(marked, "trie-marked")
        out = marked.where("spliced")
        splices.append(out.select("id", "only", *[(F.col(w) + F.col(f"down_carry_{w}")).alias(w) for w in weights]))
        passed = out.select(F.col("only").alias("id"), F.col("parent").alias("new_parent"), *[both(w).alias(f"passed_{w}") for w in weights])
        active = materialize(marked.where("not spliced").select("id", "parent", "power", *weights, *carry).join(passed, "id", "left").select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "power", *weights,
            *[(F.col(f"carry_{w}") + F.coalesce(f"passed_{w}", F.lit(0))).alias(f"carry_{w}") for w in weights]), "trie-active")
    totals = known[0]
    for part in known[1:]:
        totals = totals.unionByName(part)
    for part in reversed(splices):
        waiting = part.select(F.col("id").alias("node"), F.col("only").alias("id"), *[F.col(w).alias(f"rest_{w}") for w in weights])
        done = waiting.join(totals, "id").select(F.col("node").alias("id"), *[(F.col(w) + F.col(f"rest_{w}")).alias(w) for w in weights])
        totals = totals.unionByName(materialize(done, "trie-expanded"))
    return totals


# ---------------------------------------------------------------- nodes


_NAME = ["depth", "a", "b"]


def _ends(ends: DataFrame, rows: int) -> DataFrame:
    """(depth, a, b, ends_sha256) of nodes where conversations end.

    A node's ids are joined to chunks in order, in as many tasks as they span;
    only chunks meet in the task that hashes them, one after another.
    """

    def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, seq, last, out = None, [], 0, 0, []
        for batch in parts:
            piece = batch.column(4)[0].as_py() if batch.num_rows else 0
            for *mine, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if mine != name or len(ids) * 12 > CHUNK:
                    if ids:
                        out.append([*name, last, seq, ",".join(ids)])
                    seq = seq + 1 if mine == name else 0
                    name, ids = mine, []
                ids.append(str(c))
                last = piece
            if len(out) > 10_000:
                yield send(out)
                out = []
        if ids:
            out.append([*name, last, seq, ",".join(ids)])
        if out:
            yield send(out)

    def send(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=[*_NAME, "piece", "seq", "ids"])

    kinds = [pa.int64()] * 5 + [pa.string()]

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sha, out = None, None, []
        for batch in parts:
            for *mine, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if mine != name:
                    if name is not None:
                        out.append([*name, sha.hexdigest()])
                    name, sha = mine, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if len(out) > 10_000:
                yield named(out)
                out = []
        if name is not None:
            yield named([*out, [*name, sha.hexdigest()]])

    def named(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), [*kinds[:3], pa.string()])], names=[*_NAME, "ends_sha256"])

    n = _n_pieces(ends, rows)
    chunks = (ends.repartitionByRange(n, *_NAME, "c").sortWithinPartitions(*_NAME, "c")
              .select(*_NAME, "c", F.spark_partition_id().cast("long").alias("piece"))
              .mapInArrow(joined, "depth long, a long, b long, piece long, seq long, ids string"))
    return (chunks.repartition(n, *_NAME).sortWithinPartitions(*_NAME, "piece", "seq").select(*_NAME, "ids")
            .mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string"))


def trie(conversations: DataFrame, **options) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    turns, convs = rebuilt(conversations, **options)
    met = materialize(prefixes(turns).withColumn("depth", F.col("depth").cast("long")), "trie-prefixes")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("c").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "n_convs", "conv_id", zero.alias("n_bytes"),
        F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"))
    nodes = met.groupBy(*_NAME).agg(F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
                                    F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"))
    nodes = materialize(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
                      F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # a hot parent's children: AQE splits them, the parent being one row
    nodes = materialize(nodes.join(up, ["depth", "up_a", "up_b"], "left"), "trie-linked")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-counted")
    tree = nodes.select("id", "parent", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    totals = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    at_root = convs.where("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "c")
    ends = met.where("last").select(*_NAME, "c").unionByName(at_root)
    shas = _ends(ends, convs.count())
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(totals, "id").join(shas, _NAME, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
