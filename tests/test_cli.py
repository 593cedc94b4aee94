import json

from changes_data import event
from keyfold.__main__ import main
from keyfold.operators.flatten import flatten_changes
from keyfold.session import scratch_dir
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec
from keyfold.table import ChangeTable


def test_cli_history_maintain_query(spark, key_values, capsys):
    lake = scratch_dir(spark, "cli")
    t = ChangeTable(spark, f"{lake}/orders", get_spec("orders"))
    for i in range(3):
        recs = [(str(i), event("c", i + 1, {"order_id": i, "customer_id": 1, "status": "new",
                                                         "total_amount": 10.0}))]
        t.append_changes(flatten_changes(parse_envelope(key_values(recs)), t.spec))
    assert main(["history", "--lake", lake, "--table", "orders"], spark=spark) == 0
    assert len(json.loads(capsys.readouterr().out)) == 3
    assert main(["maintain", "--lake", lake, "--retain-hours", "0", "--allow-short-retention"], spark=spark) == 0
    res = json.loads(capsys.readouterr().out)
    assert [r["table_name"] for r in res] == ["orders"]
    assert main(["query", "--lake", lake, "order_book_by_status", "op_mix"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["order_book_by_status"]["rows"][0]["orders"] == 3
    # a query over a table that does not exist fails alone
    assert main(["query", "--lake", lake, "op_mix", "bench_full_count_all_rows"], spark=spark) == 1
    out = json.loads(capsys.readouterr().out)
    assert "rows" in out["op_mix"] and "error" in out["bench_full_count_all_rows"]


def test_cli_stats_reports_data_files_per_table(spark, key_values, capsys):
    lake = scratch_dir(spark, "cli-stats")
    t = ChangeTable(spark, f"{lake}/customers", get_spec("customers"))
    for i in range(2):
        recs = [(str(i), event("c", i + 1, {"customer_id": i, "full_name": "x"}, table="customers"))]
        t.append_changes(flatten_changes(parse_envelope(key_values(recs)), t.spec))
    assert main(["stats", "--lake", lake], spark=spark) == 0
    rows = {r["table_name"]: r for r in json.loads(capsys.readouterr().out)}
    assert set(rows) == {"customers"} and rows["customers"]["files"] >= 2
