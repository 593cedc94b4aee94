"""Reconciliation of a table against its source, and table checksums (K6, K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(table: DataFrame, source: DataFrame, primary_key: Sequence[str],
              columns: Sequence[str]) -> DataFrame:
    """Value-by-value comparison of a CDC table with the live source rows.

    One full-outer join on the key (both sides unique per key), one aggregate:
      source_rows      rows in the source
      live_rows        rows in the table not soft-deleted
      deleted_rows     soft-deleted rows in the table
      missing_rows     source rows absent from the table or deleted in it
      extra_rows       live table rows the source does not have
      mismatched_rows  live rows present on both sides with any column different
    plus `mismatch_<column>` per compared column (NULL-safe comparison).
    """
    pk = list(primary_key)
    t = table.select(*pk, F.struct(*[F.col(c) for c in list(columns) + ["_deleted"]]).alias("_t"))
    s = source.select(*pk, F.struct(*[F.col(c) for c in columns]).alias("_s"))
    j = t.join(s, pk, "full_outer")
    t_live = F.col("_t").isNotNull() & ~F.col("_t._deleted")
    both = t_live & F.col("_s").isNotNull()
    diffs = {c: ~F.col("_t").getField(c).eqNullSafe(F.col("_s").getField(c)) for c in columns}
    any_diff = None
    for d in diffs.values():
        any_diff = d if any_diff is None else (any_diff | d)
    aggs = [
        F.count_if(F.col("_s").isNotNull()).alias("source_rows"),
        F.count_if(t_live).alias("live_rows"),
        F.count_if(F.col("_t").isNotNull() & F.col("_t._deleted")).alias("deleted_rows"),
        F.count_if(F.col("_s").isNotNull() & ~t_live).alias("missing_rows"),
        F.count_if(t_live & F.col("_s").isNull()).alias("extra_rows"),
        F.count_if(both & any_diff).alias("mismatched_rows"),
    ]
    aggs += [F.count_if(both & d).alias(f"mismatch_{c}") for c, d in diffs.items()]
    return j.agg(*aggs)


#: Buckets that a bucket is divided into, and how often.
FAN, LEVELS = 256, 2


def _buckets(pk: Sequence[str], level: int) -> Column:
    """The bucket of a key after ``level`` divisions: a longer prefix of its hash."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in pk]), F.lit(FAN ** LEVELS)).cast("long") / F.lit(FAN ** (LEVELS - level))


def bucket_checksums(rows: DataFrame, primary_key: Sequence[str], columns: Sequence[str], level: int) -> DataFrame:
    """(bucket, n, x, s): rows, and exclusive or and sum of their hashes, per bucket.

    The sum tells apart what the exclusive or doesn't: rows that are there twice.
    """
    h = F.xxhash64(*[F.col(f"`{c}`") for c in [*primary_key, *columns]])
    return rows.groupBy(F.floor(_buckets(primary_key, level)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s"))


def reconcile_by_checksums(table: DataFrame, source: DataFrame, primary_key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """What ``reconcile`` returns, by a tree of checksums on either side (K6, K7).

    Both sides are summed up in ``FAN`` buckets of the key's hash; only buckets
    that differ are divided again, and only rows of the last ones that differ are
    joined. Where nothing differs no row is. The driver holds at most
    ``FAN ** LEVELS`` bucket numbers.
    """
    pk = list(primary_key)
    here = table.select(*pk, *columns, "_deleted")
    live, there = here.where(~F.col("_deleted")), source.select(*pk, *columns)
    differing: list[int] | None = None
    for level in range(1, LEVELS + 1):
        sides = [_in_buckets(side, pk, level - 1, differing) for side in (live, there)]
        a, b = (bucket_checksums(side, pk, columns, level) for side in sides)
        same = a["n"].eqNullSafe(b["n"]) & a["x"].eqNullSafe(b["x"]) & a["s"].eqNullSafe(b["s"])
        met = a.join(b, "bucket", "full_outer").where(~same).select("bucket")
        differing = [r.bucket for r in met.collect()]
        if not differing:
            break
    joined = reconcile(_in_buckets(here, pk, LEVELS, differing), _in_buckets(there, pk, LEVELS, differing), pk, columns) if differing else None
    counts = there.agg(F.count(F.lit(1)).alias("source_rows"))
    rows = here.agg(F.count_if(~F.col("_deleted")).alias("live_rows"), F.count_if(F.col("_deleted")).alias("deleted_rows"))
    totals = {"source_rows": counts.scalar(), "live_rows": rows.select("live_rows").scalar(), "deleted_rows": rows.select("deleted_rows").scalar()}
    names = ["missing_rows", "extra_rows", "mismatched_rows", *[f"mismatch_{c}" for c in columns]]
    if joined is None:
        joined = table.sparkSession.range(1).select(*[F.lit(0).cast("long").alias(c) for c in names])
    return joined.select(*[value.alias(c) for c, value in totals.items()], *names)


def _in_buckets(rows: DataFrame, pk: Sequence[str], level: int, wanted: list[int] | None) -> DataFrame:
    if wanted is None:
        return rows
    spark = rows.sparkSession
    held = F.broadcast(spark.createDataFrame([(b,) for b in wanted], "_bucket long"))  # at most FAN ** LEVELS
    return rows.withColumn("_b", F.floor(_buckets(pk, level))).join(held, F.col("_b") == F.col("_bucket"), "left_semi").drop("_b")


def table_checksum(table: DataFrame, *, with_hash: bool = False) -> DataFrame:
    """Row count and LSN sum (compare before/after a replay); optionally an
    order-independent content hash (bit_xor of row hashes, Spark-only)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum("_lsn").cast("long").alias("lsn_sum")]
    if with_hash:
        cols = [c for c in table.columns if c != "_ingested_at"]
        aggs.append(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in cols])).alias("content_hash"))
    return table.agg(*aggs)
