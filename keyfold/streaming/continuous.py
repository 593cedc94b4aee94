"""Continuous views over a change stream.

* `latest_per_key_view`: M10 as a stateful streaming aggregate: per key the
  change with the largest (lsn, event time, delete flag, fingerprint), and
  whether the key ever had another change than a delete, in update mode. The state store holds one row per key, not the events.
* `windowed_op_counts_view`: change counts per event-time window and op, with a
  watermark bounding the state.

Both are written with `foreachBatch` into a Parquet folder, a directory per
query and micro-batch, which a retried batch overwrites. `read_latest_rows`
keeps the newest row per group by the change order itself, so the folder read
back equals the query's final result table, whichever query wrote it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.predicates import HASH, SEEN, change_order
from keyfold.operators.flatten import with_fingerprint
from keyfold.spec import TableSpec


def latest_per_key_view(changes: DataFrame, spec: TableSpec) -> DataFrame:
    changes = with_fingerprint(changes.drop("_ingested_at") if "_ingested_at" in changes.columns else changes)
    pk = [F.col(f"`{c}`") for c in spec.primary_key]
    others = [c for c in changes.columns if c not in spec.primary_key]
    agg = changes.groupBy(*pk).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), change_order()).alias("_w"),
        F.bool_or(~F.col("_deleted")).alias(SEEN),
    )
    return agg.select(*pk, *[F.col("_w").getField(c).alias(c) for c in others], SEEN)


def windowed_op_counts_view(changes: DataFrame, *, window: str = "1 hour", watermark: str = "1 day",
                            group_by: str = "_op") -> DataFrame:
    """Counts per (tumbling event-time window, `group_by`), late data bounded by
    the watermark. Event time = the envelope's `ts_ms`."""
    timed = changes.withColumn("_event_time", F.timestamp_millis(F.col("_event_ts_ms")))
    return (
        timed.withWatermark("_event_time", watermark)
        .groupBy(F.window("_event_time", window).alias("w"), F.col(group_by))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.unix_millis(F.col("w.start")).alias("window_start_ms"),
            F.col(group_by),
            F.col("events"),
        )
    )


def start_view(view: DataFrame, out_dir: str, checkpoint: str, *, name: str | None = None, once: bool = True, mode: str = "update"):
    """Run a view into a folder; `mode` append writes each window once, when the watermark has closed it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        (batch.withColumns({"_query": F.lit(query), "_batch": F.lit(batch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_query", "_batch").parquet(out_dir))

    writer = view.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return writer.trigger(**trigger).start()


def read_latest_rows(spark, out_dir: str, group_columns: Sequence[str]) -> DataFrame:
    """Newest emitted row per group (update mode re-emits a group when it changes).

    For changes, newest means the change order, and a key that was only ever
    deleted is left out; for counts, the largest, since counts only grow. Both
    are partial aggregates before the shuffle."""
    rows = spark.read.parquet(out_dir)
    groups = [F.col(f"`{c}`") for c in group_columns]
    values = [c for c in rows.columns if c not in (*group_columns, "_query", "_batch", SEEN)]
    order = change_order() if HASH in rows.columns else F.struct(*[F.col(f"`{c}`") for c in values])
    kept = [F.max_by(F.struct(*[F.col(f"`{c}`") for c in values]), order).alias("_w")]
    if SEEN in rows.columns:
        kept.append(F.bool_or(SEEN).alias(SEEN))
    latest = rows.groupBy(*groups).agg(*kept)
    if SEEN in rows.columns:
        latest = latest.filter(SEEN)
    return latest.select(*groups, *[F.col("_w").getField(c).alias(c) for c in values])
