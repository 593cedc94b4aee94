"""State that expires, sessions, and lag sketches."""

import time

from pyspark.sql import functions as F

from changes_data import event, order
from keyfold.operators import layout
from keyfold.operators.flatten import flatten_changes
from keyfold.session import scratch_dir
from keyfold.sources.envelope import KAFKA_SHAPE, parse_envelope
from keyfold.spec import get_spec
from keyfold.streaming import continuous, expiring, sessions
from keyfold.table import ChangeTable
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
                       T.StructField("status", T.StringType()), T.StructField("amount", T.DoubleType())])
ORDERS = get_spec("orders").with_(schema=SCHEMA)


class Topic:
    """A folder of records and a view over it, drained on demand."""

    def __init__(self, spark, key_values, label, view, **start):
        self.spark, self.key_values, self.root = spark, key_values, scratch_dir(spark, label)
        self.view, self.start = view, start

    def drain(self, records):
        self.key_values(records).coalesce(1).write.mode("append").parquet(f"{self.root}/topic")
        stream = self.spark.readStream.schema(KAFKA_SHAPE).parquet(f"{self.root}/topic")
        query = continuous.start_view(self.view(flatten_changes(parse_envelope(stream), ORDERS)), f"{self.root}/out", f"{self.root}/checkpoint", **self.start)
        query.awaitTermination()
        return query


def test_state_expires_and_survives_a_restart(spark, key_values):
    ttl = 12_000
    topic = Topic(spark, key_values, "ttl", lambda rows: expiring.latest_per_key_expiring(rows, ORDERS, ttl_ms=ttl))
    with expiring.rocksdb_state(spark):
        topic.drain([("1", event("c", 10, order(1))), ("1", event("u", 30, order(1, "paid"))), ("2", event("c", 11, order(2))), ("3", event("d", 9, order(3)))])
        latest = lambda: {r.order_id: r.status for r in continuous.read_latest_rows(spark, f"{topic.root}/out", ["order_id"]).collect()}
        assert latest() == {1: "paid", 2: "new"}  # 3 was only ever deleted
        alive = lambda: {r.key.order_id for r in expiring.live_keys(spark, f"{topic.root}/checkpoint").collect()}
        assert alive() == {1, 2, 3}
        begun = time.time()
        topic.drain([("1", event("u", 20, order(1, "stale"))), ("4", event("c", 40, order(4)))])  # a restart: its state is still there
        took = time.time() - begun
        assert latest() == {1: "paid", 2: "new", 4: "new"}
        time.sleep(max(0.0, ttl / 1000 - took) + 2)
        rows = spark.read.parquet(f"{topic.root}/out").count()
        topic.drain([("2", event("u", 5, order(2, "older")))])
        assert spark.read.parquet(f"{topic.root}/out").count() == rows + 1  # 2 was silent for too long: its change counts as the first
        assert 2 in alive() and 3 not in alive()
    assert spark.conf.get(expiring.PROVIDER, None) != expiring.ROCKSDB


MINUTE = 60_000


def at(minute, key=1, lsn=None):
    return (str(key), event("u", lsn or minute + 1, order(key), at=1_600_000_000_000 + minute * MINUTE))


def closed(topic):
    base = 1_600_000_000_000 + 40
    if not layout.list_files(topic.spark, f"{topic.root}/out").take(1):
        return []
    return sorted((r.order_id, (r.session_start_ms - base) // MINUTE, (r.session_end_ms - base) // MINUTE, r.events)
                  for r in topic.spark.read.parquet(f"{topic.root}/out").collect())


def sessions_topic(spark, key_values):
    return Topic(spark, key_values, "sessions", lambda rows: sessions.sessions_view(rows, ["order_id"], gap="10 minutes", watermark="30 minutes"), mode="append")


def test_sessions_merge_and_close(spark, key_values):
    topic = sessions_topic(spark, key_values)
    with sessions.merged_early(spark):
        topic.drain([at(0), at(5), at(14), at(40), at(3, key=2)])
        assert closed(topic) == []
        topic.drain([at(26), at(33)])  # joins 40, which is open, through 33
        topic.drain([at(500, key=9)])
    assert closed(topic) == [(1, 0, 14, 3), (1, 26, 40, 3), (2, 3, 3, 1)]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, key_values):
    topic = sessions_topic(spark, key_values)
    topic.drain([at(0), at(300)])
    query = topic.drain([at(2), at(290)])  # 2 is too late, 290 is not
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    topic.drain([at(900, key=9)])
    assert dropped == 1 and closed(topic) == [(1, 0, 0, 1), (1, 290, 300, 2)]


def test_a_gap_of_just_that_length_parts_or_joins_alike(spark, key_values):
    topic = sessions_topic(spark, key_values)
    topic.drain([at(0), at(10), at(25), at(900, key=9)])
    assert closed(topic) == [(1, 0, 10, 2), (1, 25, 25, 1)]


def test_lag_quantiles_from_commits_alone(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "lag"), get_spec("orders"))
    for part in range(3):
        rows = flatten_changes(parse_envelope(key_values([(str(k), event("c", k + 1, order(k))) for k in range(part * 100, part * 100 + 100)])), t.spec)
        t.append_changes(rows.withColumn("_ingested_at", F.timestamp_millis(F.col("_event_ts_ms") + F.col("order_id"))))
    got = {r.probability: r.lag_ms for r in t.lag_quantiles((0.0, 0.5, 1.0)).collect()}
    assert got[0.0] == 0 and got[1.0] == 299 and abs(got[0.5] - 149) <= 2
    assert "log/_commit" not in t.lag_quantiles()._jdf.queryExecution().toString()
    t.optimize()
    assert t.lag_quantiles((1.0,)).first().lag_ms == 299
    empty = ChangeTable(spark, scratch_dir(spark, "lag"), get_spec("orders"))
    empty.append_changes(rows.where("false"))
    assert empty.lag_quantiles().count() == 0
