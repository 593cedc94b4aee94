"""Change-event envelope -> one normalised change row per record.

Envelope: {"before": {...}|null, "after": {...}|null,
           "source": {"lsn": .., "table": .., "ts_ms": .., "snapshot": ..},
           "op": "c"|"u"|"d"|"r"|"t", "ts_ms": ..}

The whole envelope is parsed by a single `from_json`. `before`/`after` are
declared as strings, which makes `from_json` return the raw JSON text of those
subtrees; the row image stays JSON so its schema can be inferred per batch.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from keyfold.functions.predicates import OP_DELETE, OP_TRUNCATE

# Field names and types of the change envelope and its `source`
# block, as the capture connector emits them.
SOURCE_SCHEMA = StructType(
    [
        StructField("version", StringType()),
        StructField("connector", StringType()),
        StructField("name", StringType()),
        StructField("ts_ms", LongType()),
        StructField("snapshot", StringType()),
        StructField("db", StringType()),
        StructField("schema", StringType()),
        StructField("table", StringType()),
        StructField("txId", LongType()),
        StructField("lsn", LongType()),
    ]
)

ENVELOPE_SCHEMA = StructType(
    [
        StructField("before", StringType()),
        StructField("after", StringType()),
        StructField("source", SOURCE_SCHEMA),
        StructField("op", StringType()),
        StructField("ts_ms", LongType()),
    ]
)

# Columns of a Kafka-shaped record (key/value plus position).
KAFKA_SHAPE = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", LongType()),
        StructField("offset", LongType()),
        StructField("timestamp", LongType()),
    ]
)


def _read(df: DataFrame, value_column: str, key_column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(_key, _value, _change, _image): each record's text, its parsed envelope, and the JSON of
    the row that the change is about (what a delete removed, else what is there now)."""
    text = F.col(value_column).cast("string")
    read = df.select(F.col(key_column).cast("string").alias("_key"), text.alias("_value"),
                     F.from_json(text, ENVELOPE_SCHEMA).alias("_change"), *keep)
    return read.withColumn("_image", _image(F.col("_change")))


def _image(change: Column) -> Column:
    return F.when(change["op"].eqNullSafe(OP_DELETE), change["before"]).otherwise(change["after"])


#: What each column of a change row is, in terms of what `_read` gives. A
#: record without an LSN comes before all others; `snapshot` is free text that
#: is missing or "false" for a live change.
CHANGE_ROW = {
    "_key": "_key",
    "_after_json": "_change.after",
    "_before_json": "_change.before",
    "_op": "_change.op",
    "_lsn": "ifnull(_change.source.lsn, 0L)",
    "_source_ts_ms": "_change.source.ts_ms",
    "_event_ts_ms": "_change.ts_ms",
    "_source_table": "_change.source.table",
    "_is_snapshot": "ifnull(_change.source.snapshot, 'false') <> 'false'",
    "_row_json": "_image",
}


#: Those that a table keeps or is made from: what `flatten_changes` reads.
TABLE_ROW = ("_row_json", "_op", "_lsn", "_source_ts_ms", "_event_ts_ms", "_is_snapshot")


def _change_row() -> list[Column]:
    return [F.expr(what).alias(name) for name, what in CHANGE_ROW.items()]


def parse_envelope(df: DataFrame, *, value_column: str = "value", key_column: str = "key") -> DataFrame:
    """Raw records -> normalised change rows (P1-P8): all records that have an image.

    Tombstones (no value or an empty one), malformed JSON and truncations have
    none. `dead_letters` on the same input tells what was left out, and why.

    The test is within the list that is exploded: as a filter on the parsed record it
    would move below the parse and repeat it (and what makes the text) for its own sake.
    """
    texts = df.select(F.col(key_column).cast("string").alias("_key"), F.col(value_column).cast("string").alias("_value"))
    imaged = F.filter(F.array(F.from_json("_value", ENVELOPE_SCHEMA)), lambda change: _image(change).isNotNull())
    changes = texts.select("_key", F.explode(imaged).alias("_change"))
    return changes.withColumn("_image", _image(F.col("_change"))).select(*_change_row())


def _unfit(text: Column, kind: DataType) -> Column:
    """Whether a key's text can't be a value of the type that the table stores it with, without loss."""
    if isinstance(kind, IntegralType) or (isinstance(kind, DecimalType) and kind.scale == 0):
        return ~text.rlike("^-?[0-9]+$") | text.try_cast(kind).isNull()
    if isinstance(kind, (StringType, StructType, ArrayType)):
        return F.lit(False)
    return text.try_cast(kind).isNull()


def _reason(primary_key: Sequence[str] | None, key_types: Mapping[str, DataType] | None = None) -> Column:
    """Why a record is unusable; NULL when `parse_envelope` keeps it.

    Reasons are exclusive. `key_types` are the types that the table stores its
    key columns with; a key that doesn't fit is `bad_key`."""
    blank = F.expr("coalesce(_change.op, _change.before, _change.after) is null and _change.source is null")
    reason = F.when(F.col("_image").isNull(),
                    F.when(F.coalesce(F.col("_value"), F.lit("")) == "", F.lit("tombstone"))
                    .when(blank, F.lit("malformed"))
                    .when(F.col("_change.op") == OP_TRUNCATE, F.lit("truncate"))
                    .otherwise(F.lit("no_image")))
    if primary_key:
        texts = [(F.get_json_object("_image", f"$['{c}']"), (key_types or {}).get(c)) for c in primary_key]
        missing = functools.reduce(operator.or_, [t.isNull() for t, _ in texts])
        reason = reason.when(missing, F.lit("null_key"))
        unfit = [_unfit(t, kind) for t, kind in texts if kind is not None]
        if unfit:
            reason = reason.when(functools.reduce(operator.or_, unfit), F.lit("bad_key"))
    return reason


def classify_records(
    df: DataFrame,
    *,
    primary_key: Sequence[str] | None = None,
    value_column: str = "value",
    key_column: str = "key",
) -> DataFrame:
    """Every record with `_reason` (NULL = usable). One parse feeds both splits."""
    return _read(df, value_column, key_column).select("_key", "_value", _reason(primary_key).alias("_reason"))


def parse_with_reasons(
    df: DataFrame,
    *,
    primary_key: Sequence[str] | None = None,
    key_types: Mapping[str, DataType] | None = None,
    keep: Sequence[str] = (),
    value_column: str = "value",
    key_column: str = "key",
) -> DataFrame:
    """One envelope parse feeding both outputs: the normalised change-row
    columns plus `_reason` (NULL = usable) and `_value` (the raw text, kept only
    for unusable records). `usable_rows` and `unusable_rows` split it; persist
    it once when both are needed. Columns in `keep` go along."""
    reason = _reason(primary_key, key_types)
    return _read(df, value_column, key_column, keep).select(
        *keep, *_change_row(), reason.alias("_reason"), F.when(reason.isNotNull(), F.col("_value")).alias("_value"))


def usable_rows(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The change rows that can be applied: what `parse_envelope` returns, with a key that fits."""
    return classified.filter(F.col("_reason").isNull()).select(*keep, *CHANGE_ROW)


def unusable_rows(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return classified.filter(F.col("_reason").isNotNull()).select(*keep, "_key", "_value", "_reason")


def dead_letters(
    df: DataFrame,
    *,
    primary_key: Sequence[str] | None = None,
    value_column: str = "value",
    key_column: str = "key",
) -> DataFrame:
    """Records the parse path drops, with the reason (P9): tombstone, malformed,
    truncate, no_image, null_key (and bad_key, given the key types)."""
    classified = classify_records(
        df, primary_key=primary_key, value_column=value_column, key_column=key_column
    )
    return classified.filter(F.col("_reason").isNotNull())
