"""Row image JSON -> typed payload columns + CDC metadata."""

from __future__ import annotations

import functools
import logging
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from keyfold.functions.predicates import HASH, OP_DELETE, row_fingerprint
from keyfold.functions.schema import infer_payload_schema
from keyfold.spec import TableSpec

log = logging.getLogger(__name__)


def flatten_with_schema(batch: DataFrame, schema: StructType, spec: TableSpec | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Expand `_row_json` against `schema` and attach the metadata columns.

    Payload names starting with `_` would shadow metadata; they are dropped and
    logged. Rows whose primary key is NULL can never match on merge and are
    dropped here (they appear in `dead_letters` with reason null_key). Columns
    in `keep` go along.
    """
    dropped = [f.name for f in schema.fields if f.name.startswith("_")]
    if dropped:
        log.warning("dropping payload columns that collide with metadata: %s", dropped)
    fields = [f for f in schema.fields if not f.name.startswith("_")]
    # a column without any value has no type yet; it stays void for the table to decide
    valued = StructType([f for f in fields if not isinstance(f.dataType, NullType)])
    keys = [k for k in spec.primary_key if k in valued.fieldNames()] if spec is not None else []
    row = F.from_json(F.col("_row_json"), valued) if valued.fields else F.lit(None)
    if keys:
        # rows with a key, by a test within the list: a filter would move below the parse and repeat it
        keyed = F.filter(F.array(row), lambda r: functools.reduce(operator.and_, [r[k].isNotNull() for k in keys]))
        parsed = batch.select("*", F.explode(keyed).alias("_row"))
    else:
        parsed = batch.withColumn("_row", row)
    out = parsed.select(
        *keep,
        *[(F.lit(None) if isinstance(f.dataType, NullType) else F.col("_row").getField(f.name)).alias(f.name) for f in fields],
        F.col("_op"),
        F.col("_lsn"),
        F.col("_source_ts_ms"),
        F.col("_event_ts_ms"),
        F.col("_is_snapshot"),
        (F.col("_op") == F.lit(OP_DELETE)).alias("_deleted"),
        F.current_timestamp().alias("_ingested_at"),
    )
    if spec is not None:
        if len(keys) < len(spec.primary_key):
            out = out.filter(F.lit(False))  # no image has the column: the same as a NULL key in all of them
    return out


def flatten_changes(batch: DataFrame, spec: TableSpec, schema: StructType | None = None, *,
                    keep_void: bool = False) -> DataFrame | None:
    """Pinned schema, else the given one, else inferred from this batch (one job).

    Returns None when there is no usable schema (empty batch, nothing parses).
    """
    schema = spec.schema or schema or infer_payload_schema(batch, keep_void=keep_void)
    if schema is None:
        return None
    return flatten_with_schema(batch, schema, spec)


def with_fingerprint(changes: DataFrame) -> DataFrame:
    """Add the deterministic last tie-break column used by every collapse."""
    if HASH in changes.columns:
        return changes
    payload = [c for c in changes.columns if not c.startswith("_")]
    return changes.withColumn(HASH, row_fingerprint(payload))
