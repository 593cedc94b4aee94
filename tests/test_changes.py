from changes_data import event, order
from keyfold.operators.dedupe import collapse_counts, deduplicate_batch, deduplicate_with_seen
from keyfold.operators.flatten import flatten_changes
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import TableSpec, get_spec

ORDERS = get_spec("orders")
INVENTORY = get_spec("inventory")


def flat(batch, spec=ORDERS):
    return flatten_changes(parse_envelope(batch), spec)


def test_latest_change_per_key(key_values):
    b = key_values([("1", event("c", 10, order(1, "new"))),
                    ("1", event("u", 11, order(1, "paid"))),
                    ("1", event("u", 12, order(1, "shipped")))])
    out = deduplicate_batch(flat(b), ORDERS).collect()
    assert len(out) == 1 and out[0]["_lsn"] == 12 and out[0]["status"] == "shipped"


def test_delete_wins_tie_at_same_lsn(key_values):
    b = key_values([("1", event("u", 20, order(1, "paid"))),
                    ("1", event("d", 20, order(1, "paid")))])
    out = deduplicate_batch(flat(b), ORDERS).collect()
    assert len(out) == 1 and out[0]["_deleted"] is True


def test_event_time_breaks_lsn_tie_nulls_last(key_values):
    b = key_values([("1", event("u", 5, order(1, "late"), at=2_000)),
                    ("1", event("u", 5, order(1, "early"), at=1_000))])
    assert deduplicate_batch(flat(b), ORDERS).first()["status"] == "late"


def test_exact_ties_resolve_deterministically(key_values):
    recs = [("1", event("u", 5, order(1, s))) for s in ("a", "b", "c", "d")]
    first = deduplicate_batch(flat(key_values(recs)), ORDERS).first()["status"]
    again = deduplicate_batch(flat(key_values(list(reversed(recs)))), ORDERS).first()["status"]
    assert first == again


def test_composite_key(key_values):
    inv = lambda p, w, q: {"product_id": p, "warehouse_id": w, "quantity": q}
    b = key_values([("k", event("c", 1, inv(1, 1, 10), table="inventory")),
                    ("k", event("u", 2, inv(1, 1, 5), table="inventory")),
                    ("k", event("c", 3, inv(1, 2, 99), table="inventory"))])
    out = {(r["product_id"], r["warehouse_id"]): r["quantity"]
           for r in deduplicate_batch(flat(b, INVENTORY), INVENTORY).collect()}
    assert out == {(1, 1): 5, (1, 2): 99}


def test_seen_flag_and_counts(key_values):
    b = key_values([("1", event("c", 1, order(1))),
                    ("1", event("d", 2, order(1))),
                    ("2", event("d", 3, order(2))),
                    ("3", event("c", 4, order(3)))])
    f = flat(b)
    seen = {r["order_id"]: (r["_deleted"], r["_seen"]) for r in deduplicate_with_seen(f, ORDERS).collect()}
    assert seen == {1: (True, True), 2: (True, False), 3: (False, True)}
    c = collapse_counts(f, ORDERS).first()
    assert (c["events"], c["deduped"], c["collapsed"]) == (4, 3, 1)


def test_payload_columns_with_underscore_dropped_and_null_keys_removed(key_values):
    b = key_values([("1", event("c", 1, {**order(1), "_secret": 1})),
                    ("2", event("c", 2, {**order(2), "order_id": None}))])
    f = flat(b)
    assert "_secret" not in f.columns
    assert [r["order_id"] for r in f.collect()] == [1]


def test_pinned_schema_skips_inference(key_values, spark):
    from pyspark.sql import types as T
    pinned = TableSpec("orders", ("order_id",), schema=T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("status", T.StringType())]))
    b = key_values([("1", event("c", 1, order(1, "x", extra_col=5)))])
    f = flatten_changes(parse_envelope(b), pinned)
    assert [c for c in f.columns if not c.startswith("_")] == ["order_id", "status"]
