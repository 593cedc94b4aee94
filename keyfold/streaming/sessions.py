"""Sessions of a key: stretches of changes without a gap.

`session_window` merges what comes within `gap` of a session on either side, so
a late change may join two sessions. The watermark says when a session can't
grow any more; then it is emitted, once, and its state is gone. Rows of a
partition are merged before the shuffle, so a hot key leaves a map task as its
sessions, not as its rows.

A quiet topic has no watermark that moves. A heartbeat (any record later than
the last session by gap and watermark, under a key that no consumer reads)
closes what is open, as capture connectors send them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


@contextlib.contextmanager
def merged_early(spark: SparkSession) -> Iterator[None]:
    """Queries started inside merge the sessions of a map task before the shuffle."""
    before = spark.conf.get(EARLY)
    spark.conf.set(EARLY, "true")
    try:
        yield
    finally:
        spark.conf.set(EARLY, before)


def sessions_view(changes: DataFrame, keys: Sequence[str], *, gap: str = "30 minutes", watermark: str = "2 hours") -> DataFrame:
    """(keys, session_start_ms, session_end_ms, events, last_lsn) of closed sessions; the end is that of the last change, without the gap.

    Rows older than the watermark are dropped (counted by the query's progress);
    rows without an event time have no place and are left out.
    """
    timed = changes.where(F.col("_event_ts_ms").isNotNull()).withColumn("_event_time", F.timestamp_millis(F.col("_event_ts_ms")))
    names = [F.col(f"`{c}`") for c in keys]
    return (timed.withWatermark("_event_time", watermark)
            .groupBy(F.session_window("_event_time", gap).alias("w"), *names)
            .agg(F.count(F.lit(1)).alias("events"), F.max("_event_ts_ms").alias("session_end_ms"), F.max("_lsn").alias("last_lsn"))
            .select(*names, F.unix_millis(F.col("w.start")).alias("session_start_ms"), "session_end_ms", "events", "last_lsn"))
