import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changes_data import event, order
from keyfold.operators.dedupe import deduplicate_batch, deduplicate_with_seen
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.merge import apply_changes, fold_changes, resolve_latest, stack_batches, visible
from keyfold.plans.pipeline import resolve_log
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec

from keyfold.table import ChangeTable
from keyfold.session import scratch_dir

ORDERS = get_spec("orders")


def changes(key_values, records, spec=ORDERS):
    return flatten_changes(parse_envelope(key_values(records)), spec).drop("_ingested_at")


def merge_all(key_values, batches, spec=ORDERS):
    state = None
    for recs in batches:
        state = apply_changes(state, deduplicate_batch(changes(key_values, recs, spec), spec), spec)
    return state


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_insert_update_soft_delete(key_values):
    st = merge_all(key_values, [
        [("1", event("c", 1, order(1))), ("2", event("c", 2, order(2)))],
        [("1", event("u", 3, order(1, "paid"))), ("2", event("d", 4, order(2)))],
    ])
    assert rows(st, "order_id", "status", "_deleted") == [(1, "paid", False), (2, "new", True)]
    assert rows(st.filter(~F.col("_deleted")), "order_id") == [(1,)]


def test_hard_delete_removes_row(key_values):
    spec = ORDERS.with_(hard_delete=True)
    st = merge_all(key_values, [[("1", event("c", 1, order(1)))],
                                [("1", event("d", 2, order(1)))]], spec)
    assert st.count() == 0


def test_out_of_order_event_is_noop(key_values):
    st = merge_all(key_values, [[("1", event("u", 100, order(1, "new")))],
                                [("1", event("u", 50, order(1, "stale")))]])
    assert rows(st, "status", "_lsn") == [("new", 100)]


def test_replay_is_idempotent(key_values):
    batch = [("1", event("c", 1, order(1))), ("2", event("c", 2, order(2))),
             ("1", event("u", 3, order(1, "paid")))]
    once = merge_all(key_values, [batch])
    four = merge_all(key_values, [batch] * 4)
    assert rows(once, "order_id", "status", "_lsn") == rows(four, "order_id", "status", "_lsn")
    assert four.count() == 2


def test_unseen_delete_not_inserted(key_values):
    st = merge_all(key_values, [[("1", event("c", 1, order(1)))],
                                [("99", event("d", 2, order(99)))]])
    assert rows(st, "order_id") == [(1,)]


def test_snapshot_then_live(key_values):
    st = merge_all(key_values, [
        [("1", event("r", 1, order(1), snapshot="true")),
         ("2", event("r", 2, order(2), snapshot="true"))],
        [("1", event("u", 3, order(1, "paid")))],
    ])
    assert rows(st, "order_id", "_is_snapshot") == [(1, False), (2, True)]


def test_new_column_appears_and_old_rows_null(key_values):
    st = merge_all(key_values, [[("1", event("c", 1, order(1)))],
                                [("2", event("c", 2, order(2, priority="high")))]])
    assert "priority" in st.columns
    assert rows(st, "order_id", "priority") == [(1, None), (2, "high")]


def test_evolved_column_updates_old_row(key_values):
    st = merge_all(key_values, [[("1", event("c", 1, order(1)))],
                                [("1", event("u", 2, order(1, "paid", priority="low")))]])
    assert rows(st, "order_id", "status", "priority") == [(1, "paid", "low")]


def test_column_absent_from_batch_keeps_stored_value(key_values):
    st = merge_all(key_values, [[("1", event("c", 1, order(1, priority="high")))],
                                [("1", event("u", 2, order(1, "paid")))]])
    assert rows(st, "status", "priority") == [("paid", "high")]
    # resolve over the stacked log applies the same rule through `_cols`
    log = stack_batches([changes(key_values, [("1", event("c", 1, order(1, priority="high")))]),
                         changes(key_values, [("1", event("u", 2, order(1, "paid")))])])
    assert rows(resolve_latest(log, ORDERS), "status", "priority") == [("paid", "high")]


def test_type_drift_in_a_merge(key_values):
    st = merge_all(key_values, [[("1", event("c", 1, order(1, amount=1.5)))],
                                [("1", event("u", 2, order(1, amount=7)))]])
    assert dict(st.dtypes)["amount"] == "double"
    assert rows(st, "amount") == [(7.0,)]


@pytest.mark.parametrize("values, kind, expected", [
    ([100, 7.25], "double", [100.0, 7.25]),
    ([100, "n/a"], "string", ["100", "n/a"]),
    ([7.25, "n/a", 3], "string", ["7.25", "n/a", "3"]),
    ([5, 12345678901234567890], "decimal(20,0)", [Decimal(5), Decimal("12345678901234567890")]),
    ([12345678901234567890, 5], "decimal(20,0)", [Decimal("12345678901234567890"), Decimal(5)]),
    ([None, 5], "bigint", [None, 5]),
    ([5, None, 7], "bigint", [5, None, 7]),
    ([True, 3], "string", ["true", "3"]),
    ([100.0, 7], "double", [100.0, 7.0]),
    ([{"a": 1}, {"a": 2.5, "b": "x"}], "struct<a:double,b:string>", [(1.0, None), (2.5, "x")]),
])
def test_type_drift_in_a_table_loses_nothing(spark, key_values, values, kind, expected):
    """Each value arrives in a batch of its own; older files are read through the widened type, before and after compaction."""
    t = ChangeTable(spark, scratch_dir(spark, "drift"), ORDERS.with_(partition_by=(), zorder_by=("order_id",)))
    for i, v in enumerate(values):
        batch = parse_envelope(key_values([(str(i), event("c", i, {"order_id": i, "v": v}))]))
        t.append_changes(flatten_changes(batch, ORDERS, keep_void=True))
    for _ in range(2):
        got = t.read()
        assert dict(got.dtypes)["v"] in (kind, "string" if values[0] is None else kind)
        if dict(got.dtypes)["v"] == kind:
            assert [tuple(r.v) if isinstance(r.v, tuple) else r.v for r in got.orderBy("order_id").collect()] == expected
        t.optimize()


def test_keys_keep_their_type(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "keys"), ORDERS)
    for batch in ([("1", event("c", 1, order(1)))], [("A", event("c", 2, order("A1"))), ("B", event("c", 3, order("B2"))), ("7", event("c", 4, order("7")))]):
        t.append_changes(flatten_changes(parse_envelope(key_values(batch)), ORDERS))
    assert sorted(r.order_id for r in t.read().collect()) == [1, 7]


# ---------------------------------------------------------- order independence

BATCHES = [
    [("1", event("c", 1, order(1))), ("2", event("c", 2, order(2))),
     ("3", event("c", 3, order(3)))],
    [("2", event("d", 10, order(2))), ("4", event("d", 11, order(4))),
     ("1", event("u", 12, order(1, "paid")))],
    [("3", event("u", 5, order(3, "late"))), ("1", event("u", 6, order(1, "old"))),
     ("4", event("c", 7, order(4)))],
]
# key 4: inserted at LSN 7, deleted at LSN 11 -> a soft-deleted row, whatever the arrival order.
EXPECTED = [(1, "paid", False), (2, "new", True), (3, "late", False), (4, "new", True)]


@pytest.mark.parametrize("perm", list(itertools.permutations(range(3))))
def test_fold_gives_one_state_in_every_order(key_values, perm):
    state = None
    for i in perm:
        state = fold_changes(state, deduplicate_with_seen(changes(key_values, BATCHES[i]), ORDERS), ORDERS)
    assert rows(visible(state, ORDERS), "order_id", "status", "_deleted") == EXPECTED


def test_resolve_whole_log(key_values):
    log = changes(key_values, [r for b in BATCHES for r in b])
    assert rows(resolve_latest(log, ORDERS), "order_id", "status", "_deleted") == EXPECTED


def test_guarded_merge_loses_a_delete_that_precedes_its_insert(key_values):
    """Documents the reference rule's order dependence (quirk Q3): the delete of
    key 4 meets no row and leaves no trace, so the older insert lands live."""
    got = rows(merge_all(key_values, BATCHES), "order_id", "status", "_deleted")
    assert got[:3] == EXPECTED[:3]
    assert got[3] == (4, "new", False)


def test_insert_and_delete_in_one_batch_leaves_soft_deleted_row(key_values):
    """Q16: with the seen flag the result does not depend on batch boundaries."""
    one = [("5", event("c", 1, order(5))), ("5", event("d", 2, order(5)))]
    st = fold_changes(None, deduplicate_with_seen(changes(key_values, one), ORDERS), ORDERS)
    assert rows(visible(st, ORDERS), "order_id", "_deleted") == [(5, True)]


def test_nested_object_gains_a_field(key_values, spark):
    from keyfold.session import scratch_dir
    from keyfold.table import ChangeTable
    t = ChangeTable(spark, scratch_dir(spark, "nested"), ORDERS)
    t.append_changes(changes(key_values, [("1", event("c", 1, order(1, ship={"city": "A"})))]))
    t.append_changes(changes(key_values, [("2", event("c", 2, order(2, ship={"city": "B", "zip": 7})))]))
    got = {r["order_id"]: (r["ship"]["city"], r["ship"]["zip"]) for r in t.read().collect()}
    assert got == {1: ("A", None), 2: ("B", 7)}
    # the in-memory merge widens the same way
    st = merge_all(key_values, [[("1", event("c", 1, order(1, ship={"city": "A"})))],
                                [("1", event("u", 2, order(1, ship={"city": "C", "zip": 9})))]])
    assert [(r["ship"]["city"], r["ship"]["zip"]) for r in st.collect()] == [("C", 9)]


def test_latest_state_of_some_columns(key_values):
    """The wanted columns of the same rows as in the whole state; others aren't in the aggregate's buffers."""
    batches = [key_values([("1", event("c", 5, order(1, "a"))), ("1", event("u", 5, order(1, "b"))), ("2", event("c", 2, order(2)))]),
               key_values([("2", event("d", 9, order(2, "gone"))), ("3", event("d", 4, order(3))), ("1", event("u", 1, order(1, priority="high")))])]
    whole = resolve_log(batches, ORDERS)
    some = resolve_log(batches, ORDERS, ["status", "priority"])
    picked = ["order_id", "status", "priority", "_deleted"]
    assert sorted(map(tuple, some.select(*picked).collect())) == sorted(map(tuple, whole.select(*picked).collect()))
    aggregates = [line for line in some._jdf.queryExecution().optimizedPlan().toString().splitlines() if "max_by" in line]
    assert aggregates and not any("customer_id" in line for line in aggregates)
