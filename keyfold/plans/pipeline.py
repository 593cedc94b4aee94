"""Offline batch route: Kafka-shaped batches -> change rows -> table state.

Each batch is parsed, its payload schema inferred (one aggregate), flattened and
collapsed; the state is then produced by one of the three merge forms. Nothing
is collected to the driver except the inferred schema string per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from keyfold.operators.dedupe import deduplicate_batch, deduplicate_with_seen
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.merge import (
    apply_changes,
    fold_changes,
    latest_state,
    partial_columns,
    stack_batches,
    visible,
)
from keyfold.sources.envelope import parse_envelope
from keyfold.spec import TableSpec


def flattened(batch: DataFrame, spec: TableSpec) -> DataFrame | None:
    """`batch`: records, or change rows that are parsed already."""
    return flatten_changes(batch if "_row_json" in batch.columns else parse_envelope(batch), spec)


def flattened_batches(batches: Sequence[DataFrame], spec: TableSpec) -> list[DataFrame]:
    out = []
    for b in batches:
        f = flattened(b, spec)
        if f is not None:
            out.append(f.drop("_ingested_at"))
    return out


def merge_in_order(batches: Sequence[DataFrame], spec: TableSpec, order: Sequence[int] | None = None) -> DataFrame:
    """Reference-faithful route: dedupe each batch, guarded merge in the given order (M1)."""
    flat = flattened_batches(batches, spec)
    order = list(order) if order is not None else list(range(len(flat)))
    state = None
    for i in order:
        state = apply_changes(state, deduplicate_batch(flat[i], spec), spec)
    return state


def fold_in_order(batches: Sequence[DataFrame], spec: TableSpec, order: Sequence[int] | None = None) -> DataFrame:
    """Order-independent fold (M13) applied in the given order; tombstones hidden at the end."""
    flat = flattened_batches(batches, spec)
    order = list(order) if order is not None else list(range(len(flat)))
    state = None
    for i in order:
        state = fold_changes(state, deduplicate_with_seen(flat[i], spec), spec)
    return visible(state, spec)


def resolve_log(batches: Sequence[DataFrame], spec: TableSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-log resolve (M10) with per-batch column presence (E6); of all columns, or only of those beside the key."""
    flat = flattened_batches(batches, spec)
    partial = partial_columns([f.columns for f in flat])
    kept = None if columns is None else [*columns, "_deleted"]  # which rows are visible depends on it
    return visible(latest_state(stack_batches(flat), spec, partial_columns=partial, columns=kept), spec)
