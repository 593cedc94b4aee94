"""Files chosen by zones, z-ranges and Bloom filters never miss a row."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from changes_data import event, order
from keyfold.operators import layout, skipping
from keyfold.operators.flatten import flatten_changes
from keyfold.session import scratch_dir
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import get_spec
from keyfold.table import ChangeTable

ORDERS = get_spec("orders").with_(partition_by=())


def z_of(values, bits):
    return sum(((v >> bit) & 1) << (bit * len(values) + j) for bit in range(bits) for j, v in enumerate(values))


@pytest.mark.parametrize("limit", [4, 16, 10_000])
def test_z_ranges_cover_the_box(limit):
    rng, bits = random.Random(2), 4
    for n in (1, 2, 3):
        for _ in range(20):
            lows = [rng.randrange(16) for _ in range(n)]
            highs = [rng.randrange(lo, 16) for lo in lows]
            ranges = skipping.z_ranges(lows, highs, bits, limit)
            assert len(ranges) <= max(limit, 1) and all(a <= b for a, b in ranges)
            assert all(x[1] + 1 < y[0] for x, y in itertools.pairwise(ranges))
            inside = {z_of(v, bits) for v in itertools.product(*[range(lo, hi + 1) for lo, hi in zip(lows, highs)])}
            covered = {z for a, b in ranges for z in range(a, b + 1)}
            assert inside <= covered and (limit < 10_000 or inside == covered)


def test_empty_box_has_no_range():
    assert skipping.z_ranges([3], [2], 4) == []


@pytest.fixture(scope="module")
def table(spark):
    """400 orders in some forty files, and a log commit on top that moves, deletes and adds."""
    key_values = lambda pairs: spark.createDataFrame([(k, v, "t", 0, i, 0) for i, (k, v) in enumerate(pairs)],
                                                     "key string, value string, topic string, partition long, offset long, timestamp long")
    t = ChangeTable(spark, scratch_dir(spark, "skip"), ORDERS)
    write = lambda records: t.append_changes(flatten_changes(parse_envelope(key_values(records)), ORDERS))
    write([(str(k), event("c", k + 1, order(k, amount=float(k), customer_id=None if k % 50 == 0 else (k * 37) % 101))) for k in range(400)])
    t.optimize(target_file_mb=layout.bytes_under(spark, t.log_path) / (1 << 20) / 40)
    write([(str(k), event("u", 1000 + k, order(k, "moved", float(k), customer_id=(k * 37 + 50) % 101))) for k in range(0, 400, 9)]
          + [(str(k), event("d", 2000 + k, order(k))) for k in range(5, 400, 60)]
          + [(str(k), event("c", 3000 + k, order(k, customer_id=7))) for k in range(400, 410)]
          + [(str(k), event("u", 0, order(k, "old", customer_id=99))) for k in range(1, 400, 80)])
    return t


BOXES = [{"order_id": (42, 42)}, {"customer_id": (7, 7), "order_id": (100, None)}, {"customer_id": (200, 300)}, {"status": ("moved", "moved")}, {}]


@pytest.mark.parametrize("box", BOXES, ids=str)
def test_box_reads_equal_a_filter(table, box):
    key = lambda df: sorted((tuple(r) for r in df.drop("_ingested_at").collect()), key=str)
    assert key(table.read_where(box)) == key(table.read().where(skipping.in_box(box)))


def test_few_files_are_chosen(spark, table):
    n = layout.list_files(spark, f"{table.snapshot_path}/_commit=1").count()
    chosen = lambda box: table.files_for(box=box).count()
    assert n > 20 and chosen({"order_id": (42, 42)}) <= n / 4 and chosen({"customer_id": (10, 14)}) <= n / 2
    assert chosen({"customer_id": (200, 300)}) == 0


def test_ranges_choose_less_than_zones(spark, table):
    """A stretch of the z-curve has a wider box than itself: its ranges rule out more."""
    index = spark.read.parquet(f"{table.zones_path}/_commit=1")
    for box in ({"customer_id": (48, 53), "order_id": (180, 220)}, {"customer_id": (10, 60), "order_id": (190, 210)}):
        zones = index.where(skipping.meets_box(box, ["customer_id", "order_id"])).count()
        assert table.files_for(box=box).count() <= zones


def test_no_key_is_missed_and_other_files_are_left(spark, table):
    snapshot = spark.read.parquet(f"{table.snapshot_path}/_commit=1").select("order_id", F.col("_metadata.file_path").alias("file")).collect()
    files = {r.file for r in snapshot}
    rng = random.Random(1)
    for wanted in ([7], rng.sample(range(400), 3), [5000, 6000]):
        keys = spark.createDataFrame([(k,) for k in wanted], "order_id long")
        got = {r.file for r in table.files_for(keys=keys).collect()}
        holding = {r.file for r in snapshot if r.order_id in wanted}
        assert holding <= got and len(got) <= len(holding) + len(files) * 0.1 * len(wanted) + 1


def test_rows_of_keys_equal_the_state(spark, table):
    for as_of in (0, 1, 2):
        keys = spark.createDataFrame([(k,) for k in (0, 5, 9, 81, 405, 777)], "order_id long")
        key = lambda df: sorted((tuple(r) for r in df.select("order_id", "status", "customer_id", "_lsn", "_deleted").collect()), key=str)
        assert key(table.rows_of(keys, as_of)) == key(table.read(as_of).join(keys, "order_id", "left_semi"))


def test_text_keys_and_drifted_columns(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "text"), ORDERS.with_(primary_key=("code",), zorder_by=("code", "amount")))
    write = lambda records: t.append_changes(flatten_changes(parse_envelope(key_values(records)), t.spec))
    write([(str(k), event("c", k + 1, {"code": f"cust-{k:04d}", "amount": k})) for k in range(200)])
    t.optimize(target_file_mb=0.0005)
    box = {"code": ("cust-0050", "cust-0059")}
    assert t.read_where(box).count() == 10
    assert t.files_for(box=box).count() < layout.list_files(spark, f"{t.snapshot_path}/_commit=1").count()
    write([("1", event("u", 999, {"code": "cust-0001", "amount": "n/a"}))])  # amount is text from now on
    assert t.read_where({"amount": ("n/a", "n/a")}).count() == 1 and t.read_where({"amount": ("7", "7")}).count() == 1


def test_a_table_without_a_snapshot_is_read_whole(spark, key_values):
    t = ChangeTable(spark, scratch_dir(spark, "raw"), ORDERS)
    t.append_changes(flatten_changes(parse_envelope(key_values([(str(k), event("c", k + 1, order(k))) for k in range(5)])), ORDERS))
    assert t.files_for(box={"order_id": (1, 1)}) is None and t.read_where({"order_id": (1, 2)}).count() == 2


def test_filter_words_are_the_bits_of_the_keys(spark):
    """Words without a bit lie before, between and after the others, and are zero."""
    path = scratch_dir(spark, "few-keys")
    spark.range(0, 3).coalesce(1).write.parquet(path)
    n_bits = 64 * 200
    keys = spark.read.parquet(path)
    made = skipping.bloom_filters(keys, ["id"], n_bits).collect()
    places = {p for r in keys.select(F.array(*skipping._bloom_places([F.col("id")], n_bits)).alias("p")).collect() for p in r.p}
    want = [sum(1 << (p % 64) for p in places if p // 64 == w) for w in range(n_bits // 64)]
    assert len(made) == 1 and [w % (1 << 64) for w in made[0].words] == want
    assert 3 < sum(w > 0 for w in want) < 30


def test_filter_of_a_large_file_is_built_in_proportion_to_it(spark):
    """A filter of 100,000 words takes seconds: the work doesn't grow with their square."""
    path = scratch_dir(spark, "many-keys")
    spark.range(640_000).coalesce(1).write.parquet(path)
    n_bits = skipping.bloom_bits(640_000, 1)
    begun = time.monotonic()
    words = skipping.bloom_filters(spark.read.parquet(path), ["id"], n_bits).first().words
    assert time.monotonic() - begun < 25
    assert len(words) == n_bits // 64 and 0.4 < sum(bin(w % (1 << 64)).count("1") for w in words) / n_bits < 0.6
