"""Folding into bucketed snapshots: right in any order, and without shuffling the snapshot."""

import random
import re

import pytest

from changes_data import event, order
from keyfold.operators import layout
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.merge import fold_into, latest_state
from keyfold.session import scratch_dir
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec
from keyfold.table import ChangeTable

PLAIN = get_spec("orders").with_(partition_by=(), zorder_by=())
BUCKETED = PLAIN.with_(buckets=4)


def write(table, key_values, records):
    table.append_changes(flatten_changes(parse_envelope(key_values(records)), table.spec))


def content(df):
    return sorted((tuple(r) for r in df.drop("_ingested_at").select(*sorted(set(df.columns) - {"_ingested_at"})).collect()), key=str)


def log(seed, commits=5):
    rng = random.Random(seed)
    lsns = list(range(1, commits * 12 + 1))
    rng.shuffle(lsns)
    return [[(str(k), event(rng.choice("cud"), lsn, order(k, rng.choice(["new", "paid"]), float(lsn), **({"tier": f"t{lsn}"} if b % 2 else {}))))
             for lsn in lsns[b * 12:b * 12 + 12] for k in [rng.randrange(9)]] for b in range(commits)]


def test_equals_the_plain_fold_at_every_step(spark, key_values):
    a, b = (ChangeTable(spark, scratch_dir(spark, s.buckets and "bucketed" or "plain"), s) for s in (PLAIN, BUCKETED))
    for i, batch in enumerate(log(4)):
        for t in (a, b):
            write(t, key_values, batch)
            if i in (1, 3):
                t.optimize()
        assert content(a.read()) == content(b.read())
    again = ChangeTable(spark, b.path, BUCKETED)
    assert content(again.read()) == content(a.read())


def test_the_snapshot_is_not_shuffled(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "bucketed"), BUCKETED)
    batches = log(1)
    write(t, key_values, batches[0])
    t.optimize()
    assert layout.list_files(spark, f"{t.snapshot_path}/_commit=1").count() <= 4
    write(t, key_values, batches[1])
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin"):]
    scans = re.findall(r"FileScan parquet[^\n]*", side)
    assert len(scans) == 2 and "keyfold_" in scans[0] and "Bucketed: true" in scans[0] and "keyfold_" not in scans[1]
    before_snapshot = side[:side.index(scans[0])]
    assert "Exchange" not in before_snapshot and side.count("Exchange") == 1  # the log's


def test_other_sessions_find_the_buckets(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "bucketed"), BUCKETED)
    write(t, key_values, log(2)[0])
    t.optimize()
    want = content(t.read())
    for r in spark.sql("show tables").where("tableName like 'keyfold_%'").collect():
        spark.sql(f"drop table {r.tableName}")  # the files stay: they aren't the catalog's
    assert content(ChangeTable(spark, t.path, BUCKETED).read()) == want


def test_fold_into_with_columns_that_batches_lack(spark):
    schema = "order_id long, v string, w string, _op string, _lsn long, _event_ts_ms long, _deleted boolean, _h long, _seen boolean"
    snap = spark.createDataFrame([(1, "a", "x", "c", 10, 1, False, 1, True), (2, "b", "y", "c", 10, 1, False, 1, True), (3, "c", "z", "d", 9, 1, True, 1, False)], schema)
    rows = [(1, "n", None, "u", 12, 1, False, 1, True, ["order_id", "v"]), (1, "m", "late", "u", 8, 1, False, 1, True, ["order_id", "v", "w"]),
            (2, "o", "new", "u", 11, 1, False, 1, True, ["order_id", "v", "w"]), (2, "p", None, "d", 13, 1, True, 1, False, ["order_id", "v"]),
            (3, "q", None, "c", 5, 1, False, 1, True, ["order_id", "v"]), (4, "r", None, "c", 5, 1, False, 1, True, ["order_id", "v"])]
    changes = spark.createDataFrame(rows, schema + ", _cols array<string>")
    from pyspark.sql import functions as F

    whole = snap.withColumn("_cols", F.array(F.lit("order_id"), F.lit("v"), F.lit("w"))).unionByName(changes)
    want = latest_state(whole, PLAIN, partial_columns=["w"])
    got = fold_into(snap, changes, PLAIN, ["w"])
    assert content(got) == content(want.select(*got.columns))


def test_no_partitions_with_buckets():
    with pytest.raises(ValueError):
        get_spec("orders").with_(buckets=4)
