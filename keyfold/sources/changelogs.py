"""Change logs derived from the given base tables, and change capture from two
table states (K13).

Everything here is a Spark projection of the base tables: the log grows with
them, and the expected final state of each log is a closed-form SQL expression
over the same base table, which is what the oracle checks.

Fixed values of the orders log (batch, op, which keys, LSN offset):
  batch 0  r  every order          lsn = k + 1            snapshot "true"
  batch 1  u  k % 3 = 0            lsn = 2000000000 + k   status 'shipped', amount + 1, adds `priority`
  batch 1  d  k % 7 = 0            lsn = 3000000000 + k   before image of batch 0
  batch 1  d  k % 11 = 0, unseen   lsn = 3000000000 + k   order_id = -k - 1
  batch 2  u  k % 5 = 0, late      lsn = 1000000000 + k   status 'stale', amount 0.5
Each delete is followed by a NULL-valued record (tombstone); batch 1 also
carries broken records: k % 13 = 0 malformed JSON, k % 17 = 0 empty value,
k % 19 = 0 truncate event without images, k % 23 = 0 update without images,
k % 29 = 0 insert whose image has a NULL order_id (lsn 5000000000 + k).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.time import epoch_millis
from keyfold.session import spread

NO_NULL_SKIP = {"ignoreNullFields": "false"}
SOURCE_TS_BASE = 1_700_000_000_000


def _image(pairs: Sequence[tuple[str, Column]]) -> Column:
    return F.struct(*[c.alias(n) for n, c in pairs])


def envelope_value(
    op: str | Column,
    lsn: Column,
    *,
    table: str,
    after: Column | None = None,
    before: Column | None = None,
    ts_ms: Column | None = None,
    snapshot: str | None = None,
) -> Column:
    """JSON text of one change envelope, built column-wise (no Python per row)."""
    ts = ts_ms if ts_ms is not None else (F.lit(SOURCE_TS_BASE) + lsn % F.lit(1_000_000))
    op_col = op if isinstance(op, Column) else F.lit(op)
    source = F.struct(
        F.lit("2.7.3.Final").alias("version"),
        F.lit("postgresql").alias("connector"),
        F.lit("shop").alias("name"),
        ts.cast("long").alias("ts_ms"),
        (F.lit(snapshot) if snapshot is not None else F.lit(None).cast("string")).alias("snapshot"),
        F.lit("shop").alias("db"),
        F.lit("public").alias("schema"),
        F.lit(table).alias("table"),
        lsn.cast("long").alias("txId"),
        lsn.cast("long").alias("lsn"),
    )
    env = F.struct(
        (before if before is not None else F.lit(None).cast("string")).alias("before"),
        (after if after is not None else F.lit(None).cast("string")).alias("after"),
        source.alias("source"),
        op_col.alias("op"),
        (ts + F.lit(5)).cast("long").alias("ts_ms"),
    )
    return F.to_json(env, NO_NULL_SKIP)


def kafka_records(df: DataFrame, key: Column, value: Column, topic: str, offset: Column) -> DataFrame:
    """Shape rows like a topic: key, value, topic, partition, offset, timestamp."""
    return df.select(
        F.to_json(key).alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(F.to_json(key)), F.lit(8)).cast("long").alias("partition"),
        offset.cast("long").alias("offset"),
        F.lit(SOURCE_TS_BASE).cast("long").alias("timestamp"),
    )


def _records_where(df: DataFrame, records: Sequence[tuple[Column, Column, Column, Column]], topic: str) -> DataFrame:
    """Topic rows from one scan: for each row of `df` those of (condition, key, value, offset) whose condition holds."""
    made = F.array(*[F.when(cond, F.struct(key.alias("key"), value.alias("value"), offset.cast("long").alias("offset")))
                     for cond, key, value, offset in records])
    rows = df.select(F.explode(made).alias("r")).where("r is not null").select("r.*")
    return kafka_records(rows, F.col("key"), F.col("value"), topic, F.col("offset"))


# ----------------------------------------------------------------- orders


def _order_image(o: DataFrame, *, status: Column | None = None, amount: Column | None = None,
                 order_id: Column | None = None, priority: bool = False) -> Column:
    pairs = [
        ("order_id", order_id if order_id is not None else F.col("o_orderkey")),
        ("customer_id", F.col("o_custkey")),
        ("status", status if status is not None else F.col("o_orderstatus")),
        ("total_amount", amount if amount is not None else F.col("o_totalprice")),
    ]
    if priority:
        pairs.append(("priority", F.col("o_orderpriority")))
    return _image(pairs)


def orders_change_batches(spark: SparkSession, sf_dir: str, *, with_junk: bool = True) -> list[DataFrame]:
    """The three Kafka-shaped batches of the orders log (see module docstring)."""
    o = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    ))
    k = F.col("o_orderkey")
    topic = "orders"
    key = F.struct(k.alias("order_id"))

    snap_lsn = k + 1
    b0 = kafka_records(
        o, key, envelope_value("r", snap_lsn, table=topic, after=_order_image(o), snapshot="true"),
        topic, snap_lsn,
    )

    # Batch 1 in one pass: every order gives the records whose condition it meets.
    here, ghost = F.struct(k.alias("order_id")), F.struct((-k - 1).alias("order_id"))
    upd_lsn, del_lsn = F.lit(2_000_000_000) + k, F.lit(3_000_000_000) + k
    nothing, junk = F.lit(None).cast("string"), F.lit(-1).cast("long")
    records = [
        (k % 3 == 0, here, envelope_value("u", upd_lsn, table=topic, before=_order_image(o), after=_order_image(
            o, status=F.lit("shipped"), amount=F.col("o_totalprice") + 1, priority=True)), upd_lsn),
        (k % 7 == 0, here, envelope_value("d", del_lsn, table=topic, before=_order_image(o)), del_lsn),
        (k % 7 == 0, here, nothing, del_lsn),
        (k % 11 == 0, ghost, envelope_value("d", del_lsn, table=topic, before=_order_image(o, order_id=-k - 1)), del_lsn),
        (k % 11 == 0, ghost, nothing, del_lsn),
    ]
    if with_junk:
        junk_lsn, null_lsn = F.lit(4_000_000_000) + k, F.lit(5_000_000_000) + k
        records += [
            (k % 13 == 0, here, F.lit("{bad"), junk),
            (k % 17 == 0, here, F.lit(""), junk),
            (k % 19 == 0, here, envelope_value("t", junk_lsn, table=topic), junk),
            (k % 23 == 0, here, envelope_value("u", junk_lsn, table=topic), junk),
            (k % 29 == 0, here, envelope_value("c", null_lsn, table=topic, after=_order_image(
                o, order_id=F.lit(None).cast("long"))), null_lsn),
        ]
    b1 = _records_where(o, records, topic)

    late = o.filter(k % 5 == 0)
    late_lsn = F.lit(1_000_000_000) + k
    b2 = kafka_records(
        late, key,
        envelope_value("u", late_lsn, table=topic, before=_order_image(late),
                       after=_order_image(late, status=F.lit("stale"), amount=F.lit(0.5))),
        topic, late_lsn,
    )
    return [b0, b1, b2]


# ------------------------------------------------------------ other tables


def events_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-activity log: every event is an upsert of its user, LSN = event_id;
    `props` becomes a nested object in the image."""
    e = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    ts_ms = epoch_millis(e, "ts")
    image = _image([
        ("user_id", F.col("user_id")),
        ("event_id", F.col("event_id")),
        ("event_type", F.col("event_type")),
        ("value", F.col("value")),
        ("ts_ms", ts_ms),
        ("props", F.parse_json(F.col("props"))),
    ])
    lsn = F.col("event_id")
    return kafka_records(
        e, F.struct(F.col("user_id")),
        envelope_value("c", lsn, table="user_activity", after=image, ts_ms=ts_ms - 5),
        "user_activity", lsn,
    )


def inventory_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock levels keyed by (product_id, warehouse_id) = (l_partkey, l_suppkey).

    LSN = l_orderkey * 10 + l_linenumber; the event time is the ship date, which
    orders two changes of one key that share an LSN (the four line columns are
    not unique in every extract). Lines with l_linenumber = 1 arrive as
    snapshot reads, the rest as updates.
    """
    li = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"))
    lsn = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    ship_ms = epoch_millis(li, "l_shipdate")
    image = _image([
        ("product_id", F.col("l_partkey")),
        ("warehouse_id", F.col("l_suppkey")),
        ("quantity", F.col("l_quantity").cast("long")),
        ("reorder_level", F.lit(25).cast("long")),
    ])
    op = F.when(F.col("l_linenumber") == 1, F.lit("r")).otherwise(F.lit("u"))
    return kafka_records(
        li, F.struct(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("warehouse_id")),
        envelope_value(op, lsn, table="inventory", after=image, ts_ms=ship_ms), "inventory", lsn,
    )


def order_item_id(ship_ms: Column, prefix: str = "l_") -> Column:
    """Line identity: order, line number, part, supplier, ship date, quantity
    (the first four alone repeat in some extracts)."""
    p = prefix
    return F.concat_ws("-", F.col(f"{p}orderkey"), F.col(f"{p}linenumber"),
                       F.col(f"{p}partkey"), F.col(f"{p}suppkey"), ship_ms,
                       F.col(f"{p}quantity").cast("long"))


def order_items_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: inserts, plus a cascaded delete for every line of an order
    deleted in the orders log (o_orderkey % 7 = 0)."""
    li = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"))
    lsn = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    item_id = order_item_id(epoch_millis(li, "l_shipdate"))
    image = _image([
        ("order_item_id", item_id),
        ("order_id", F.col("l_orderkey")),
        ("product_id", F.col("l_partkey")),
        ("quantity", F.col("l_quantity").cast("long")),
        ("unit_price", F.col("l_extendedprice")),
    ])
    key = F.struct(item_id.alias("order_item_id"))
    del_lsn = F.lit(3_000_000_000) + F.col("l_orderkey")
    return _records_where(li, [
        (F.lit(True), key, envelope_value("c", lsn, table="order_items", after=image), lsn),
        (F.col("l_orderkey") % 7 == 0, key, envelope_value("d", del_lsn, table="order_items", before=image), del_lsn),
    ], "order_items")


def customers_change_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Customers: snapshot of all, then an update adding `loyalty_tier` on
    c_custkey % 4 = 0 (the column added mid-stream)."""
    c = spread(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    k = F.col("c_custkey")
    base = [
        ("customer_id", k),
        ("full_name", F.col("c_name")),
        ("country", F.col("c_nationkey").cast("long")),
        ("segment", F.col("c_mktsegment")),
    ]
    key = F.struct(k.alias("customer_id"))
    b0 = kafka_records(c, key, envelope_value("r", k + 1, table="customers", after=_image(base),
                                              snapshot="true"), "customers", k + 1)
    ev = c.filter(k % 4 == 0)
    tier = F.when(F.col("c_acctbal") > 5000, F.lit("gold")).otherwise(F.lit("silver"))
    lsn = F.lit(1_000_000_000) + k
    b1 = kafka_records(ev, key, envelope_value("u", lsn, table="customers",
                                               after=_image(base + [("loyalty_tier", tier)])),
                       "customers", lsn)
    return [b0, b1]


# ------------------------------------------------------- change capture


def diff_to_changes(old: DataFrame, new: DataFrame, primary_key: Sequence[str], *,
                    lsn: Column, table: str) -> DataFrame:
    """Change records that turn table state `old` into `new`.

    One full-outer join on the key: only-new -> c, only-old -> d (before image),
    both with a different image -> u. `lsn` is evaluated over the joined row
    (key columns are available unqualified).
    """
    pk = list(primary_key)
    cols = [c for c in new.columns]
    o = old.select(*pk, F.struct(*[F.col(c) for c in old.columns]).alias("_o"))
    n = new.select(*pk, F.struct(*[F.col(c) for c in cols]).alias("_n"))
    j = o.join(n, on=pk, how="full_outer")
    before, after = F.col("_o"), F.col("_n")
    differs = [~before.getField(c).eqNullSafe(after.getField(c)) if c in old.columns else after.getField(c).isNotNull() for c in cols]
    op = (F.when(before.isNull(), F.lit("c"))
          .when(after.isNull(), F.lit("d"))
          .when(functools.reduce(operator.or_, differs), F.lit("u")))
    j = j.withColumn("_op", op).filter(F.col("_op").isNotNull())
    value = envelope_value(
        F.col("_op"), lsn, table=table,
        after=F.when(F.col("_op") != "d", F.col("_n")),
        before=F.col("_o"),
    )
    return kafka_records(j, F.struct(*[F.col(c) for c in pk]), value, table, lsn)
