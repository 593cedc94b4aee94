"""Latest row per key with state that expires.

`latest_per_key_view` keeps a row for every key that ever came. Here a key's
state lives in RocksDB, off the heap, and is dropped once the key has been
silent for `ttl`: the state follows the keys that are in use. Beyond the TTL a
late change can't be told from a new one any more, so `ttl` must exceed what the
log can be late by; the stored table, which folds by LSN, isn't affected.

A key's rows of a micro-batch are gone through one after another and reduced to
the winner before the state is touched: one read and at most one write per key.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyfold.functions.predicates import HASH, SEEN
from keyfold.operators.flatten import with_fingerprint
from keyfold.spec import TableSpec

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Processing time always asks for one more batch, so a drain would never end: only data makes a batch.
SETTINGS = {PROVIDER: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a query takes its settings along when it starts."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


#: What a key's state holds: the change's position, whether the key ever had another change than a delete, and the row as JSON.
STATE = T.StructType([T.StructField("_lsn", T.LongType()), T.StructField("_event_ts_ms", T.LongType()), T.StructField("_deleted", T.BooleanType()),
                      T.StructField(HASH, T.LongType()), T.StructField(SEEN, T.BooleanType()), T.StructField("_image", T.StringType())])


def _position(lsn, at, deleted, fingerprint, *_) -> tuple:
    """The change order as a Python value; no event time comes first."""
    return lsn, at is not None, at or 0, deleted, fingerprint


class LatestPerKey(StatefulProcessor):
    """Value state: the winning change so far."""

    def __init__(self, keys: list[str], ttl_ms: int):
        self.keys, self.ttl_ms = keys, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        best = before = self.latest.get()
        seen = best is not None and best[4]
        for row in rows:
            seen = seen or not row["_deleted"]
            new = tuple(row[c] for c in STATE.names if c != SEEN)
            new = (*new[:4], False, new[4])
            if best is None or _position(*new) > _position(*best):
                best = new
        if best is None:
            return
        best = (*best[:4], seen, best[5])
        # written even when it stays the same: the key was heard of, its time starts anew
        self.latest.update(best)
        if before is None or best != tuple(before):
            yield Row(**dict(zip(self.keys, key)), **dict(zip(STATE.names, best)))

    def close(self) -> None:
        pass


def latest_per_key_expiring(changes: DataFrame, spec: TableSpec, *, ttl_ms: int) -> DataFrame:
    """A stream of the rows of keys whose latest change has changed. Start it within `rocksdb_state`."""
    changes = with_fingerprint(changes.drop("_ingested_at") if "_ingested_at" in changes.columns else changes)
    keys, fixed = list(spec.primary_key), [c for c in STATE.names if c not in (SEEN, "_image")]
    image = T.StructType([f for f in changes.schema.fields if f.name not in (*keys, *fixed)])
    packed = changes.select(*[F.col(f"`{k}`") for k in keys], *fixed, F.to_json(F.struct(*[F.col(f"`{c}`") for c in image.names])).alias("_image"))
    out = T.StructType([*[changes.schema[k] for k in keys], *STATE.fields])
    latest = packed.groupBy(*[F.col(f"`{k}`") for k in keys]).transformWithState(LatestPerKey(keys, ttl_ms), out, "update", "ProcessingTime")
    return latest.withColumn("_image", F.from_json("_image", image)).select(
        *[F.col(f"`{k}`") for k in keys], *fixed, SEEN, *[F.col("_image")[c].alias(c) for c in image.names])


def live_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, value) of the state as the last micro-batch left it, read from the checkpoint."""
    with rocksdb_state(spark):
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load()
