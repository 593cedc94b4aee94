from decimal import Decimal

from pyspark.sql import functions as F

from keyfold.operators.history import row_history
from keyfold.operators.reconcile import reconcile, table_checksum
from keyfold.plans import analytics as K
from keyfold.sources.changelogs import diff_to_changes
from keyfold.sources.envelope import parse_envelope
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.dedupe import deduplicate_batch
from keyfold.operators.merge import apply_changes
from keyfold.spec import get_spec

ORDERS_SCHEMA = "order_id long, customer_id long, status string, total_amount double, _op string, " \
                "_lsn long, _deleted boolean"


def orders(spark):
    rows = [(1, 10, "paid", 10.005, "u", 5, False), (2, 10, "paid", 20.10, "c", 6, False),
            (3, 11, "new", 5.0, "c", 7, False), (4, 12, "paid", 99.0, "d", 9, True)]
    return spark.createDataFrame(rows, ORDERS_SCHEMA)


def test_order_book_by_status(spark):
    got = {r["status"]: (r["orders"], r["revenue"], r["avg_order_value"])
           for r in K.order_book_by_status(orders(spark)).collect()}
    assert got == {"paid": (2, Decimal("30.11"), Decimal("15.06")), "new": (1, Decimal("5.00"), Decimal("5.00"))}


def test_variance_freshness_opmix(spark):
    items = spark.createDataFrame(
        [("a", 1, 2, 4.0, False), ("b", 1, 1, 2.0, False), ("c", 2, 1, 20.10, False), ("d", 3, 1, 1.0, True)],
        "order_item_id string, order_id long, quantity long, unit_price double, _deleted boolean")
    var = {r["order_id"]: r["variance"] for r in K.order_line_variance(orders(spark), items).collect()}
    # order 1: 10.01 - (2*4.00 + 1*2.00) = 0.01 -> not above 0.01; order 2 matches exactly; order 3 has no live lines
    assert var == {}
    fresh = {r["table_name"]: r["max_lsn"] for r in K.freshness({"orders": orders(spark)}).collect()}
    assert fresh == {"orders": 9}
    mix = {r["_op"]: (r["event_rows"], r["deleted_rows"]) for r in K.op_mix(orders(spark)).collect()}
    assert mix == {"u": (1, 0), "c": (2, 0), "d": (1, 1)}


def test_shortfall_top_k_tie_break(spark):
    inv = spark.createDataFrame([(1, 1, 5, 25, False), (1, 2, 5, 25, False), (2, 1, 30, 25, False),
                                 (3, 1, 0, 25, True)],
                                "product_id long, warehouse_id long, quantity long, reorder_level long, _deleted boolean")
    got = [(r["product_id"], r["warehouse_id"], r["shortfall"]) for r in K.replenishment_shortfall(inv, 1).collect()]
    assert got == [(1, 1, 20)]


def test_reconcile_counts(spark):
    table = orders(spark)
    source = spark.createDataFrame([(1, 10, "paid", 10.005), (2, 10, "new", 20.10), (4, 12, "paid", 99.0),
                                    (5, 1, "new", 1.0)],
                                   "order_id long, customer_id long, status string, total_amount double")
    r = reconcile(table, source, ["order_id"], ["customer_id", "status", "total_amount"]).first()
    assert (r["source_rows"], r["live_rows"], r["deleted_rows"]) == (4, 3, 1)
    assert (r["missing_rows"], r["extra_rows"], r["mismatched_rows"], r["mismatch_status"]) == (2, 1, 1, 1)
    c = table_checksum(table, with_hash=True).first()
    assert c["rows"] == 4 and c["lsn_sum"] == 27 and c["content_hash"] is not None


def test_diff_to_changes_round_trip(spark):
    spec = get_spec("orders")
    old = spark.createDataFrame([(1, "new", 1.0), (2, "new", 2.0), (3, "new", 3.0)],
                                "order_id long, status string, amount double")
    new = spark.createDataFrame([(1, "paid", 1.0), (3, "new", 3.0), (4, "new", 4.0)],
                                "order_id long, status string, amount double")
    recs = diff_to_changes(old, new, ["order_id"], lsn=F.lit(100) + F.col("order_id"), table="orders")
    ops = sorted((r["_op"], r["order_id"]) for r in
                 flatten_changes(parse_envelope(recs), spec).collect())
    assert ops == [("c", 4), ("d", 2), ("u", 1)]
    old_state = old.withColumns({"_op": F.lit("r"), "_lsn": F.lit(1).cast("long"), "_source_ts_ms": F.lit(0).cast("long"),
                                 "_event_ts_ms": F.lit(0).cast("long"), "_is_snapshot": F.lit(True),
                                 "_deleted": F.lit(False)})
    changes = flatten_changes(parse_envelope(recs), spec).drop("_ingested_at")
    st = apply_changes(old_state, deduplicate_batch(changes, spec), spec)
    live = sorted((r["order_id"], r["status"]) for r in K.live(st).collect())
    assert live == [(1, "paid"), (3, "new"), (4, "new")]


def test_row_history_with_a_hot_key_matches_plain_lead(spark):
    hot = [(1, "u", i) for i in range(1, 400)]
    cold = [(k, "c", 1000 + k) for k in range(2, 60)] + [(k, "u", 2000 + k) for k in range(2, 60, 2)]
    df = spark.createDataFrame(hot + cold, "order_id long, _op string, _lsn long")
    got = sorted(tuple(r) for r in row_history(df, ["order_id"], partitions=6)
                 .select("order_id", "valid_from_lsn", "valid_to_lsn").collect())
    df.createOrReplaceTempView("h")
    want = sorted(tuple(r) for r in spark.sql(
        "select order_id, _lsn, lead(_lsn) over (partition by order_id order by _lsn) from h").collect())
    assert got == want


def test_runner_keeps_going_and_caps_rows(spark):
    from keyfold.plans.runner import run_named, time_queries
    ok = lambda: spark.range(100).toDF("x")
    bad = lambda: spark.sql("select * from no_such_table_anywhere")
    out = run_named({"bad": bad, "ok": ok}, limit=10)
    assert "error" in out["bad"] and len(out["ok"]["rows"]) == 10
    assert set(time_queries({"ok": ok}, runs=2)) == {"ok"}
