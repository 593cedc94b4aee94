"""Collapse a batch to the latest change per primary key.

`deduplicate_batch` keeps the `row_number() == 1` shape on purpose: Catalyst
plans it as a Partial + Final `WindowGroupLimit`, i.e. a map-side top-1 per key
before the shuffle, so a key holding a third of the batch leaves each map task
as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.predicates import HASH, SEEN, change_order, change_order_desc
from keyfold.operators.flatten import with_fingerprint
from keyfold.spec import TableSpec


def _pk(spec: TableSpec):
    return [F.col(f"`{c}`") for c in spec.primary_key]


def deduplicate_batch(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Latest change per key: LSN desc, event time desc (NULL last), delete wins
    a tie, then the payload fingerprint for full determinism."""
    changes = with_fingerprint(changes)
    window = Window.partitionBy(*_pk(spec)).orderBy(*change_order_desc())
    return (
        changes.withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") == 1)
        .drop("_rn", HASH)
    )


def deduplicate_with_seen(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Same winner as `deduplicate_batch`, plus `_seen` = the key had any
    non-delete change in the batch (D8), so an insert+delete collapsed into one
    batch is not mistaken for a delete of a key never seen.

    One aggregate with partial aggregation on the map side; `_h` is kept for
    later folds.
    """
    changes = with_fingerprint(changes)
    others = [c for c in changes.columns if c not in spec.primary_key]
    agg = changes.groupBy(*_pk(spec)).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), change_order()).alias("_w"),
        F.bool_or(~F.col("_deleted")).alias(SEEN),
    )
    return agg.select(*_pk(spec), *[F.col("_w").getField(c).alias(c) for c in others], SEEN)


def collapse_counts(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """events, distinct keys, collapsed = events - keys (D7), as one aggregate."""
    keys = F.struct(*_pk(spec))
    return changes.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(keys).alias("deduped"),
    ).withColumn("collapsed", F.col("events") - F.col("deduped"))
