"""Property test (brute-force model on a small fixture): any batching and any batch order of a change log fold to the
state a brute-force model computes (latest change per key by LSN; a key is
visible iff it ever had a non-delete change)."""


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changes_data import event, order
from keyfold.operators.dedupe import deduplicate_with_seen
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.merge import fold_changes, resolve_latest, visible
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec

ORDERS = get_spec("orders")

events_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from(["c", "u", "d"]), st.sampled_from(["new", "paid", "gone"])),
    min_size=1, max_size=25,
)


def model(events):
    best, seen = {}, {}
    for key, op, status, lsn in events:
        seen[key] = seen.get(key, False) or op != "d"
        if key not in best or lsn > best[key][2]:
            best[key] = (status, op == "d", lsn)
    return sorted((k, *v) for k, v in best.items() if seen[k])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events_strategy, st.integers(1, 4), st.randoms(use_true_random=False))
def test_fold_and_resolve_match_model(spark, raw, n_batches, rnd):
    events = [(k, op, status, 10 * i + 1) for i, (k, op, status) in enumerate(raw)]  # unique LSNs
    rnd.shuffle(events)
    records = []
    for key, op, status, lsn in events:
        image = order(key, status)
        env = event(op, lsn, image)
        records.append((str(key), env))
    cuts = sorted(rnd.sample(range(1, len(records)), min(n_batches - 1, len(records) - 1))) if len(records) > 1 else []
    bounds = [0, *cuts, len(records)]
    batches = [records[a:b] for a, b in zip(bounds, bounds[1:]) if b > a]
    order_ = list(range(len(batches)))
    rnd.shuffle(order_)
    flat = [flatten_changes(parse_envelope(spark.createDataFrame(b, "key string, value string")), ORDERS)
            .drop("_ingested_at") for b in batches]
    state = None
    for i in order_:
        state = fold_changes(state, deduplicate_with_seen(flat[i], ORDERS), ORDERS)
    got = sorted((r["order_id"], r["status"], r["_deleted"], r["_lsn"])
                 for r in visible(state, ORDERS).collect())
    expect = model(events)
    assert got == expect
    whole = flat[0]
    for f in flat[1:]:
        whole = whole.unionByName(f)
    resolved = sorted((r["order_id"], r["status"], r["_deleted"], r["_lsn"])
                      for r in resolve_latest(whole, ORDERS).collect())
    assert resolved == expect
