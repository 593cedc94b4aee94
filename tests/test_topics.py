"""Topics that are parsed once: what is stored of them, and how a log is dealt into slices."""

from pyspark.sql import functions as F

from keyfold.operators.flatten import flatten_changes
from keyfold.plans import catalog
from keyfold.sources import files
from keyfold.sources.envelope import TABLE_ROW, parse_envelope
from keyfold.spec import get_spec

SF = "/root/testdata/sf0.001"


def test_parsed_topic_holds_what_tables_are_made_from(spark, key_values):
    from changes_data import event, order

    records = key_values([(str(k), event("c", k + 1, order(k))) for k in range(30)] + [("0", None), ("1", "{bad")])
    made = []
    parsed = files.parsed_topic(spark, ("lean", "t"), lambda: made.append(1) or records)
    again = files.parsed_topic(spark, ("lean", "t"), lambda: made.append(1) or records)
    rows = lambda df: sorted(map(str, flatten_changes(df, get_spec("orders")).drop("_ingested_at").collect()))
    assert parsed.columns == list(TABLE_ROW) and made == [1]
    assert rows(parsed) == rows(again) == rows(parse_envelope(records)) and len(rows(parsed)) == 30
    assert (spark.sparkContext.applicationId, "lean", "t") not in files._PRODUCED  # nobody has asked for the records


def test_slices_are_read_alone_and_hold_every_row_once(spark):
    rows = spark.range(1000).select("id", F.lit("x").alias("text"))
    slices = files.sliced_rows(spark, rows, F.pmod("id", F.lit(3)), 4, "test")
    assert [sorted(r.id for r in s.collect()) for s in slices] == [[k for k in range(1000) if k % 3 == i] for i in range(3)] + [[]]
    held = [set(s.inputFiles()) for s in slices]
    assert all(a.isdisjoint(b) for i, a in enumerate(held) for b in held[:i]) and held[3] == set()


def test_a_batch_of_the_levelled_log_reads_its_own_rows(spark):
    batches = catalog._twenty_commits(spark, SF)
    held = [set(b.inputFiles()) for b in batches]
    assert all(a.isdisjoint(b) for i, a in enumerate(held) for b in held[:i])
    assert all(b.where(f"_lsn % 20 <> {i}").isEmpty() for i, b in enumerate(batches))
    assert sum(b.count() for b in batches) == parse_envelope(catalog._orders_log_union(spark, SF)).count()
