"""Change events and rows that the tests are made of."""

from __future__ import annotations

import json

from keyfold.sources.envelope import SOURCE_SCHEMA

#: When the first of these events happened, in milliseconds.
START = 1_650_000_000_000


def event(op, lsn, row=None, *, old=None, new=None, table="orders", at=START, snapshot=None) -> str:
    """JSON of a change: `row` is the image that counts, `old` or `new` the other one."""
    images = {"before": row, "after": new} if op == "d" else {"before": old, "after": row}
    known = {"ts_ms": at, "snapshot": snapshot, "table": table, "txId": 7, "lsn": lsn}
    source = {f.name: known.get(f.name, "test") for f in SOURCE_SCHEMA.fields}
    return json.dumps({**images, "source": source, "op": op, "ts_ms": at + 40})


def order(order_id, status="new", amount=10.0, customer_id=1, **extra):
    return {"order_id": order_id, "customer_id": customer_id, "status": status, "amount": amount, **extra}
