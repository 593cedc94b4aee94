"""Mix sources to target token weights by entropy balancing, with DataFrame functions only.

Each document gets a rate: how often the mix takes it, between 0 and
``max_copies``. Among all rates that reach every source's target, entropy
balancing takes those nearest to 1 in the sense of sum(rate * (log rate - 1)).
The convex dual has one multiplier per source, and the optimal rates are
exponential tilts, ``min(max_copies, exp(lam * size / scale))``, with ``scale``
the source's mean size (a change of unit only).

Newton's method solves the dual: one iteration is one aggregate over
(source, size) counts, which are made once; a bracket keeps each step safe.
Nothing but one row of convergence figures reaches the driver.

Rates become whole copies by systematic rounding within the source, ordered by
size, so that neighbours of like size make up for each other. What rounding
leaves over (at most a few documents) is settled along a fixed order: documents
gain or lose copies until the source's total is its rounded target; at most one
document per source is then taken in part.

Hot sources: all prefix sums run in hashed pieces (``common.running_total``).

Cases: a null text has size 0 and is never taken; null sources form one source,
sorted last; rows with equal or null ids count separately; a source of size 0
has target 0; an empty table gives an empty result; other columns pass through,
and those named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import WORD, materialize, pieces, running_total

#: Documents per piece of a prefix sum.
ROWS_PER_PIECE = 20_000


def word_count(text: str) -> Column:
    """Number of runs of anything but ASCII white space; null: 0."""
    spaced = F.concat(F.lit(" "), F.coalesce(F.col(text).cast("string"), F.lit("")))
    # each word begins after white space, so the splits are the words
    return (F.size(F.split(spaced, r"[\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])")) - 1).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: float) -> DataFrame:
    """(source, source_size, target) from (source, size): water-filling under the cap.

    Weights repeat over the sources in code-point order, null last. A target
    above ``max_copies`` times its source's size stops there, and the excess is
    shared by weight among the others. With sources ordered by size / weight the
    capped ones come first, so prefix sums give the final level at once: source
    i is capped when size_i / weight_i <= (T - capped before) / (weight from i on).
    One row per source goes through the window.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    array = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(array, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    ratio = F.lit(float(max_copies)) * F.col("source_size") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(every)
    per = (per.withColumn("_total", total).withColumn("_cap", F.lit(float(max_copies)) * F.col("source_size"))
           .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("weight").over(onward))
           .withColumn("_capped", ratio <= F.col("_level"))
           # the level of the first source that isn't capped holds for all that aren't
           .withColumn("_at", F.min(F.when(~F.col("_capped"), F.struct(ratio, F.col("source").isNull(), F.coalesce("source", F.lit("")), "_level"))).over(every)))
    return per.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap")).otherwise(
        F.least("_cap", F.col("_at._level") * F.col("weight"))).alias("target"))


def solve(sizes: DataFrame, goals: DataFrame, max_copies: float, *, tolerance: float = 1e-6,
          max_iterations: int = 60) -> DataFrame:
    """(source, lam, scale, full) by Newton's method; ``full``: the target is all that the cap allows.

    ``sizes``: (source, size, docs). Sums are exact decimals, so reruns agree. A
    step that leaves the bracket is replaced by its middle; a bound of the
    bracket that turns out too small doubles.
    """
    mean = F.sum(F.col("size") * F.col("docs")) / F.sum("docs")
    means = sizes.groupBy("source").agg(F.greatest(mean, F.lit(1.0)).alias("scale"))
    full = F.col("target") >= max_copies * F.col("source_size") * (1 - 1e-12)
    state = materialize(goals.join(means, goals.source.eqNullSafe(means.source)).select(
        goals.source, "scale", "target", full.alias("full"), F.lit(0.0).alias("lam"),
        F.lit(-64.0).alias("low"), F.lit(64.0).alias("high"), F.lit(False).alias("done")), "mix-dual")
    exact = lambda c: F.sum(c.cast("decimal(38,6)")).cast("double")
    for _ in range(max_iterations):
        tilt = F.exp(F.col("lam") * F.col("size") / F.col("scale"))
        words = F.col("docs") * F.col("size")
        sums = (sizes.join(state.select(F.col("source").alias("_s"), "lam", "scale"), sizes.source.eqNullSafe(F.col("_s")))
                .groupBy("_s").agg(exact(words * F.least(F.lit(float(max_copies)), tilt)).alias("reached"),
                                   exact(F.when(tilt < max_copies, words * F.col("size") / F.col("scale") * tilt).otherwise(0.0)).alias("slope")))
        miss = F.col("reached") - F.col("target")
        widen_low, widen_high = (miss > 0) & (F.col("lam") <= F.col("low")), (miss < 0) & (F.col("lam") >= F.col("high"))
        low = F.when(widen_low, F.col("lam") * 2).when(miss < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(widen_high, F.col("lam") * 2).when(miss > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - miss / F.nullif("slope", F.lit(0.0))
        done = F.col("full") | (F.abs(miss) <= tolerance * F.greatest("target", F.lit(1.0)))
        state = (state.join(sums, state.source.eqNullSafe(sums._s)).withColumns({"_low": low, "_high": high, "_done": done})
                 .select("source", "scale", "target", "full",
                         F.when(F.col("_done"), F.col("lam"))
                         .when((F.col("slope") > 0) & (newton > F.col("_low")) & (newton < F.col("_high")), newton)
                         .when(widen_low, F.col("_low")).when(widen_high, F.col("_high"))
                         .otherwise((F.col("_low") + F.col("_high")) / 2).alias("lam"),
                         F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_done").alias("done")))
        state = materialize(state, "mix-dual")
        if not state.where(~F.col("done")).take(1):
            break
    return state.select("source", "scale", "full", "lam")


def mix(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_copies: int = 2,
        text: str = "text", source: str = "source", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, source, size, source_size, target, rate, copies, taken.

    ``copies``: whole copies after rounding; ``taken``: the words that the mix takes in the end.
    """
    n = F.col("size")
    slim = materialize(docs.select(*[F.col(c).alias(c) for c in keep if c not in ("source", "size")],
                                   F.col(source).alias("source"), word_count(text).alias("size")), "mix-sizes")
    sizes = materialize(slim.groupBy("source", "size").agg(F.count("*").alias("docs")), "mix-counts")
    goals = materialize(targets(sizes.select("source", (n * F.col("docs")).alias("size")), weights, share, max_copies), "mix-goals")
    dual = solve(sizes, goals, max_copies)
    tilt = F.least(F.lit(float(max_copies)), F.exp(F.col("lam") * n / F.col("scale")))
    plan = goals.join(dual.withColumnRenamed("source", "_s"), goals.source.eqNullSafe(F.col("_s"))).drop("_s")
    rated = (slim.join(plan.withColumnRenamed("source", "_s"), slim.source.eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("rate", F.when(F.col("full"), F.lit(float(max_copies))).otherwise(tilt)))
    order = [n, *[F.col(c) for c in keep if c not in ("source", "size")]]
    n_pieces = pieces(slim, ROWS_PER_PIECE)
    # rates in units of 2^-20, so that running totals are exact
    unit = 1 << 20
    whole = F.round(F.col("rate") * unit).cast("long")
    rounded = running_total(rated, ["source"], order, whole, "_before", n_pieces)
    copies = F.floor((F.col("_before") + whole) / unit) - F.floor(F.col("_before") / unit)
    rounded = materialize(rounded.withColumn("copies", copies.cast("long")).drop("_before", "lam", "scale", "full"), "mix-copies")
    got = rounded.groupBy("source").agg(F.sum(F.col("copies") * n).alias("_got")).withColumnRenamed("source", "_s")
    left = (rounded.join(got, rounded.source.eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_short", F.round("target").cast("long") - F.col("_got")))
    first = F.col("copies") * n
    room = F.when(F.col("_short") > 0, max_copies * n - first).otherwise(first)
    left = running_total(left.withColumn("_room", room), ["source"], order, F.col("_room"), "_before", n_pieces)
    moved = F.least(F.greatest(F.abs("_short") - F.col("_before"), F.lit(0)), F.col("_room"))
    taken = first + F.when(F.col("_short") > 0, moved).otherwise(-moved)
    names = [c for c in keep if c not in ("source", "size")]
    return left.select(*names, "source", "size", "source_size", "target", "rate", "copies", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, *, text: str = "text", source: str = "source", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents as the mix takes them: a row per copy, and where a copy is taken in part, its first words.

    Documents without words are never taken.
    """
    same = F.xxhash64(F.col(text))
    taken = (mix(docs.withColumn("_h", same), text=text, source=source, keep=(id_col, "_h"), **options)
             .groupBy(F.col(id_col).alias("_id"), F.col("source").alias("_source"), F.col("_h").alias("_same"), F.col("size").alias("_size"))
             .agg(F.sum("taken").alias("_taken")).where("_taken > 0"))
    rows = docs.withColumn("_h", same).dropDuplicates([id_col, source, "_h"])
    met = rows.join(taken, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("_h") == F.col("_same")))
    whole, part = (F.col("_taken") / F.col("_size")).cast("long"), F.col("_taken") % F.col("_size")
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    copies = F.sequence(F.lit(1).cast("long"), whole + F.when(part > 0, 1).otherwise(0))
    start = F.when(F.col("_copy") > whole, F.array_join(F.slice(words, F.lit(1), part.cast("int")), " ")).otherwise(F.col(text))
    return met.withColumn("_copy", F.explode(copies)).withColumn(text, start).select(*docs.columns)
