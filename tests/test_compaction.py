"""Levelled compaction, sweeping, and the change feed."""

import random

import pytest
from pyspark.sql import functions as F

from changes_data import event, order
from keyfold.operators import layout
from keyfold.operators.compaction import Piece, plan_merges
from keyfold.operators.flatten import flatten_changes
from keyfold.session import scratch_dir
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec
from keyfold.table import ChangeTable, VersionNotAvailable

ORDERS = get_spec("orders")
ONE = frozenset(["a"])


def pieces(n, columns=ONE, size=10):
    return [Piece(i, i, 0, size, columns) for i in range(n)]


def levels_of(n, fanout=4):
    """Runs that are left and bytes rewritten after n commits, compacted after each."""
    held, rewritten = [], 0
    for i in range(n):
        held.append(Piece(i, i, 0, 1, ONE))
        while groups := plan_merges(held, fanout=fanout):
            for g in groups:
                held = [p for p in held if p not in g] + [Piece(g[0].lo, g[-1].hi, g[0].level + 1, sum(p.size for p in g), ONE)]
                rewritten += sum(p.size for p in g)
    return held, rewritten


def test_short_stretches_wait():
    assert plan_merges(pieces(3)) == []
    assert [[p.lo for p in g] for g in plan_merges(pieces(9))] == [[0, 1, 2, 3], [4, 5, 6, 7]]


def test_each_row_is_rewritten_once_per_level():
    for n in (20, 64, 200):
        held, rewritten = levels_of(n)
        top = max(p.level for p in held)
        assert 4 ** top <= n and rewritten <= n * top
        assert sorted(x for p in held for x in range(p.lo, p.hi + 1)) == list(range(n))


def test_other_columns_and_large_pieces_stay_apart():
    mixed = pieces(3) + [Piece(i, i, 0, 10, frozenset(["a", "b"])) for i in range(3, 7)]
    assert [[p.lo for p in g] for g in plan_merges(mixed)] == [[3, 4, 5, 6]]
    assert plan_merges(pieces(8, size=1 << 40)) == []


def test_enclosed_rest_is_merged():
    held = [Piece(0, 3, 1, 40, ONE), Piece(4, 4, 0, 10, ONE), Piece(5, 5, 0, 10, ONE), Piece(6, 9, 1, 40, ONE)]
    assert [[p.lo for p in g] for g in plan_merges(held)] == [[4, 5]]


def test_fanout_of_one_is_refused():
    with pytest.raises(ValueError):
        plan_merges([], fanout=1)


def write(table, key_values, records):
    return table.append_changes(flatten_changes(parse_envelope(key_values(records)), table.spec))


def shuffled_log(seed, commits, keys=12):
    """Batches whose LSNs come in any order, with deletes."""
    rng = random.Random(seed)
    lsns = list(range(1, commits * 6 + 1))
    rng.shuffle(lsns)
    out = []
    for b in range(commits):
        batch = []
        for lsn in lsns[b * 6:b * 6 + 6]:
            k = rng.randrange(keys)
            batch.append((str(k), event(rng.choice("cuud"), lsn, order(k, rng.choice(["new", "paid"]), float(lsn)))))
        out.append(batch)
    return out


def content(df):
    return sorted((tuple(r) for r in df.select("order_id", "status", "amount", "_lsn", "_deleted", "_op").collect()), key=str)


def test_runs_keep_state_and_versions(spark, key_values):
    plain, merged = (ChangeTable(spark, scratch_dir(spark, x), ORDERS) for x in ("plain", "merged"))
    for batch in shuffled_log(3, 9):
        write(plain, key_values, batch)
        write(merged, key_values, batch)
        merged.compact(fanout=2)
        assert content(merged.read()) == content(plain.read())
    kinds = [c.kind for c in merged._meta()]
    assert kinds.count("run") >= 4 and len(merged._active_dirs()) < 5
    # versions before the runs are still there
    numbers = [c.commit for c in merged._meta() if c.kind == "merge"]
    for i, n in enumerate(numbers):
        assert content(merged.read(as_of=n)) == content(plain.read(as_of=i))


def test_snapshot_and_vacuum_go_on_with_runs(spark, key_values):
    plain, t = (ChangeTable(spark, scratch_dir(spark, x), ORDERS) for x in ("plain", "t"))
    log = shuffled_log(5, 8)
    for i, batch in enumerate(log):
        write(plain, key_values, batch)
        write(t, key_values, batch)
        if i == 3:
            t.optimize()
        if i > 3:
            before = layout.bytes_under(spark, t.snapshot_path)
            t.compact(fanout=2)
            assert layout.bytes_under(spark, t.snapshot_path) == before  # runs don't touch it
    t.vacuum(retain_hours=0, allow_short_retention=True, now_ms=2**45)
    assert content(t.read()) == content(plain.read())
    assert not layout.path_exists(spark, f"{t.log_path}/_commit=0")
    with pytest.raises(VersionNotAvailable):
        t.read(as_of=1)
    t.optimize()
    assert content(t.read()) == content(plain.read())


def test_columns_that_come_later_are_not_mixed(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "era"), ORDERS)
    write(t, key_values, [("1", event("c", 5, order(1, tier="gold")))])
    write(t, key_values, [("1", event("u", 10, order(1, "paid")))])
    write(t, key_values, [("1", event("u", 7, order(1, "late", tier="iron")))])
    write(t, key_values, [("2", event("c", 8, order(2, tier="tin")))])
    before = [tuple(r) for r in t.read().select("order_id", "status", "tier").orderBy("order_id").collect()]
    assert before == [(1, "paid", "iron"), (2, "new", "tin")]
    assert t.compact(fanout=2)
    assert [tuple(r) for r in t.read().select("order_id", "status", "tier").orderBy("order_id").collect()] == before


def test_sweep_takes_orphans_only(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "sweep"), ORDERS)
    for batch in shuffled_log(1, 3):
        write(t, key_values, batch)
    t.optimize()
    want = content(t.read())
    for place in ("log/_commit=50", "run/_commit=51", "snapshot/_commit=52", "_keys/_commit=52"):
        spark.read.parquet(f"{t.log_path}/_commit=0").write.parquet(f"{t.path}/{place}")
    with pytest.raises(ValueError):
        t.sweep(retain_hours=1)
    assert t.sweep() == []  # too young to be told from a write under way
    gone = t.sweep(retain_hours=0, allow_short_retention=True, now_ms=2**45)
    assert gone == ["_keys/_commit=52", "log/_commit=50", "run/_commit=51", "snapshot/_commit=52"]
    assert content(t.read()) == want and t.read(as_of=0).count() and t.files_for(box={"order_id": (0, 5)}) is not None
    assert t.sweep(retain_hours=0, allow_short_retention=True, now_ms=2**45) == []


def test_change_feed(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "feed"), ORDERS)
    write(t, key_values, [(str(k), event("c", k + 1, order(k))) for k in range(4)])
    write(t, key_values, [("0", event("u", 11, order(0, "paid"))), ("1", event("d", 12, order(1))), ("9", event("c", 13, order(9))),
                          ("8", event("d", 14, order(8)))])
    write(t, key_values, [("0", event("u", 21, order(0))), ("9", event("d", 22, order(9))), ("2", event("u", 1, order(2, "stale")))])
    feed = lambda a, b: sorted((r.order_id, r._change, r._before and r._before.status, r._after and r._after.status)
                               for r in t.changes_between(a, b).collect())
    assert feed(0, 1) == [(0, "update", "new", "paid"), (1, "delete", "new", None), (9, "insert", None, "new")]
    assert feed(0, 2) == [(1, "delete", "new", None)]  # changed and changed back, came and went
    assert feed(1, 1) == []
    t.optimize()
    assert feed(0, 3) == feed(0, 2)
    with pytest.raises(ValueError):
        t.changes_between(2, 1)
    t.vacuum(retain_hours=0, allow_short_retention=True, now_ms=2**45)
    with pytest.raises(VersionNotAvailable):
        t.changes_between(0, 3)


def test_maintenance_by_levels(spark, key_values):
    from keyfold.plans.maintenance import maintain

    lake = scratch_dir(spark, "lake")
    t = ChangeTable(spark, f"{lake}/orders", ORDERS)
    log = shuffled_log(7, 8)
    for batch in log:
        write(t, key_values, batch)
    want = content(t.read())
    first = maintain(spark, lake, [ORDERS], levelled=True).first()
    assert content(t.read()) == want and first.table_name == "orders"
    assert [c.kind for c in t._meta()].count("optimize") == 1  # no snapshot yet: the log is the table
    write(t, key_values, log[0])
    maintain(spark, lake, [ORDERS], levelled=True, fold_ratio=1e9)
    assert [c.kind for c in t._meta()].count("optimize") == 1 and content(t.read()) == want


def test_a_commit_file_is_read_once(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "meta"), ORDERS)
    for batch in shuffled_log(2, 3):
        write(t, key_values, batch)
    other, opened = ChangeTable(spark, t.path, ORDERS), []
    read = other._read_commit_file
    other._read_commit_file = lambda name: opened.append(name) or read(name)
    assert other.version() == 2 and len(opened) == 3
    write(t, key_values, [("1", event("u", 99, order(1)))])
    assert other.version() == 3 and len(opened) == 4
