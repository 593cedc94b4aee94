from pyspark.sql import functions as F

from changes_data import START, event, order
from keyfold.functions.schema import infer_payload_schema, variant_type_to_struct
from keyfold.operators.flatten import flatten_with_schema
from keyfold.sources.envelope import dead_letters, parse_envelope
from keyfold.spec import get_spec
from pyspark.sql import types as T


def test_op_types_and_snapshot_flag(key_values):
    batch = key_values([
        ("1", event("r", 1, order(1), snapshot="true")),
        ("2", event("c", 2, order(2))),
        ("3", event("u", 3, order(3, "paid"), old=order(3))),
        ("4", event("d", 4, order(4, "gone"))),
        ("5", event("r", 5, order(5), snapshot="last")),
        ("6", event("c", 6, order(6), snapshot="false")),
    ])
    rows = {r["_key"]: r for r in parse_envelope(batch).collect()}
    assert [rows[k]["_op"] for k in "123456"] == ["r", "c", "u", "d", "r", "c"]
    assert [rows[k]["_is_snapshot"] for k in "123456"] == [True, False, False, False, True, False]
    # a delete's image is its before image
    assert '"gone"' in rows["4"]["_row_json"]
    assert rows["3"]["_before_json"] is not None and '"paid"' in rows["3"]["_after_json"]
    assert rows["2"]["_lsn"] == 2 and rows["2"]["_event_ts_ms"] == START + 40


def test_tombstones_and_empty_values_dropped(key_values):
    batch = key_values([("1", event("d", 1, order(1))), ("1", None), ("2", "")])
    out = parse_envelope(batch).collect()
    assert len(out) == 1 and out[0]["_op"] == "d"


def test_missing_lsn_defaults_to_zero(key_values):
    batch = key_values([("1", event("c", None, order(1)))])
    assert parse_envelope(batch).first()["_lsn"] == 0


def test_dead_letter_reasons(key_values):
    batch = key_values([
        ("1", None),
        ("2", "{bad"),
        ("3", event("t", 3)),
        ("4", event("u", 4)),
        ("5", event("c", 5, {"order_id": None, "status": "x"})),
        ("6", event("c", 6, order(6))),
    ])
    got = {r["_key"]: r["_reason"] for r in dead_letters(batch, primary_key=["order_id"]).collect()}
    assert got == {"1": "tombstone", "2": "malformed", "3": "truncate", "4": "no_image", "5": "null_key"}
    # the parse path keeps only records with an image
    assert {r["_key"] for r in parse_envelope(batch).collect()} == {"5", "6"}


def test_variant_normaliser_rules():
    s = variant_type_to_struct(
        "OBJECT<a: BIGINT, b: DECIMAL(5,2), c: STRING, d: VOID, e: OBJECT<f: DECIMAL(21,1), "
        "g: ARRAY<BIGINT>>, `h a`: BOOLEAN, z: OBJECT<>, big: DECIMAL(25,0), amb: DECIMAL(20,0), v: VARIANT>"
    )
    types = {f.name: f.dataType for f in s.fields}
    assert types["a"] == T.LongType()
    assert types["b"] == T.DoubleType()
    assert types["c"] == T.StringType() and types["d"] == T.StringType()
    assert types["e"] == T.StructType([T.StructField("f", T.DoubleType()),
                                       T.StructField("g", T.ArrayType(T.LongType()))])
    assert types["h a"] == T.BooleanType()
    assert "z" not in types
    assert types["big"] == T.DecimalType(25, 0)
    assert types["amb"] == T.DoubleType()
    assert types["v"] == T.StringType()
    assert variant_type_to_struct(None) is None
    assert variant_type_to_struct("OBJECT<>") is None


def test_inference_matches_json_reader(spark):
    images = [
        '{"id": 1, "amount": 100.0, "name": "a", "note": null, "tags": [1, 2], "nested": {"x": 1.5}}',
        '{"id": 2, "amount": 7.25, "name": "b", "note": null, "tags": [], "nested": {"x": 2}}',
    ]
    df = spark.createDataFrame([(i,) for i in images], "_row_json string")
    ours = infer_payload_schema(df)
    reader = spark.read.json(spark.sparkContext.parallelize(images)).schema
    as_map = lambda s: {f.name: f.dataType for f in s.fields}
    assert as_map(ours) == as_map(reader)


def test_inference_none_when_nothing_parses(spark):
    df = spark.createDataFrame([("{bad",), ("[1]",)], "_row_json string")
    assert infer_payload_schema(df) is None
    assert infer_payload_schema(df.filter(F.lit(False))) is None


def test_reasons_agree_with_parse_path(key_values):
    from keyfold.sources.envelope import classify_records
    batch = key_values([
        ("1", None), ("2", ""), ("3", "{bad"), ("4", '{"after": {"order_id": 4}}'),
        ("5", event("t", 5)), ("6", event("t", 6, order(6))),
        ("7", event("u", 7)), ("8", event("d", 8, order(8))),
        ("9", event("c", 9, order(9))),
    ])
    kept = {r["_key"] for r in parse_envelope(batch).collect()}
    usable = {r["_key"] for r in classify_records(batch).collect() if r["_reason"] is None}
    assert kept == usable == {"4", "6", "8", "9"}


def test_one_parse_splits_into_usable_and_unusable(key_values):
    from keyfold.sources.envelope import parse_with_reasons, unusable_rows, usable_rows
    batch = key_values([("1", None), ("2", "{bad"), ("3", event("c", 3, order(3))),
                        ("4", event("c", 4, {"order_id": None}))])
    c = parse_with_reasons(batch, primary_key=["order_id"])
    assert [r["_key"] for r in usable_rows(c).collect()] == ["3"]  # parse_envelope keeps the NULL key, flattening drops it
    assert {r["_key"]: r["_reason"] for r in unusable_rows(c).collect()} == {"1": "tombstone", "2": "malformed", "4": "null_key"}


def test_keys_that_dont_fit_their_type(key_values):
    from pyspark.sql import types as T

    from keyfold.sources.envelope import parse_with_reasons, unusable_rows
    keys = ["A1", 5.5, "7", 8, 2 ** 70, True, "2020-01-01"]
    batch = key_values([(str(i), event("c", i, order(k))) for i, k in enumerate(keys)])
    bad = lambda kind: sorted(r["_key"] for r in unusable_rows(parse_with_reasons(
        batch, primary_key=["order_id"], key_types={"order_id": kind})).collect())
    assert bad(T.LongType()) == ["0", "1", "4", "5", "6"]
    assert bad(T.DoubleType()) == ["0", "5", "6"]
    assert bad(T.StringType()) == []


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_each_record_is_parsed_once(key_values):
    """The tests for an image and for a key don't repeat the parse below it, nor what makes the text."""
    batch = key_values([("1", event("c", 1, order(1))), ("2", None), ("3", event("c", 3, order(None))), ("4", event("d", 4, order(4)))])
    made = batch.withColumn("value", F.concat(F.col("value"), F.lit(" ")))
    changes = parse_envelope(made)
    assert _parses(changes) == 1
    assert changes._jdf.queryExecution().optimizedPlan().toString().count("concat(") == 1
    rows = changes.localCheckpoint()
    kind = infer_payload_schema(rows)
    flat = flatten_with_schema(rows, kind, get_spec("orders"))
    assert _parses(flat) == 1
    assert sorted(r.order_id for r in flat.collect()) == [1, 4]
    absent = T.StructType([f for f in kind.fields if f.name != "order_id"])
    assert flatten_with_schema(rows, absent, get_spec("orders")).collect() == []
