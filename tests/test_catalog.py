import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from keyfold.plans.catalog import NO_ORACLE, ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["status", "orders", "revenue", "avg_order_value"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return float(v)
    return v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_at_smallest_scale(spark, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "events"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    idx = sorted(range(len(names)), key=lambda i: names[i])
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want
