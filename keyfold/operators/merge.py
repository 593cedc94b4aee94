"""Folding deduplicated changes into table state.

Three operators, one set of rules:

* `apply_changes` (M1-M6): the guarded upsert/soft-delete merge of one batch
  into a table, as an equi full-outer join on the primary key. Strict
  `s._lsn > t._lsn` guard; unseen deletes are not inserted; hard deletes drop.
  Faithful for batches applied in log order (and for replays of them).
* `fold_changes` (M13): the same merge, made order-independent: an unseen delete
  is kept as a hidden tombstone (`_seen = false`) so its LSN still guards, and
  the winner is decided by the full change order. Any batch order, any
  re-batching, any replay gives one state.
* `resolve_latest` (M10): whole-log latest-per-key as one grouped aggregate
  (partial aggregation before the shuffle, so a hot key does not pile up).

Columns a batch's schema lacks keep their stored value (E6); columns the table
lacks appear with NULL for older rows (E3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions.predicates import COLS, HASH, ORD, SEEN, change_order
from keyfold.functions.schema import conform, evolve
from keyfold.operators.flatten import with_fingerprint
from keyfold.spec import TableSpec

INTERNAL = (SEEN, HASH, COLS, ORD)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _aligned(target: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides on one evolved schema: nested structs gain new fields, other
    shared columns take the stored type (a MERGE casts source to target)."""
    schema = evolve(target.schema, changes.schema)
    return conform(target, schema), conform(changes, schema)


def _joined(target: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    pk = list(spec.primary_key)
    t = target.select(*[_q(c) for c in pk], F.struct(*[_q(c) for c in target.columns]).alias("_t"))
    s = changes.select(*[_q(c) for c in pk], F.struct(*[_q(c) for c in changes.columns]).alias("_s"))
    # Equi-join on every key column; NULL never equals NULL (keys are non-null
    # after flattening anyway). Both sides hold one row per key, so the join is
    # skew-free whatever the key distribution of the raw events was.
    return t.join(s, on=pk, how="full_outer")


def _project(joined: DataFrame, target_cols, change_cols, pk, take_s: Column) -> list[Column]:
    out = [_q(c) for c in pk]
    target_cols = [c for c in target_cols if c != SEEN]
    change_cols = [c for c in change_cols if c != SEEN]
    tset, sset = set(target_cols), set(change_cols)
    ordered = [c for c in target_cols if c not in pk] + [
        c for c in change_cols if c not in pk and c not in tset
    ]
    for c in ordered:
        tc, sc = F.col("_t").getField(c), F.col("_s").getField(c)
        if c in tset and c in sset:
            out.append(F.when(take_s, sc).otherwise(tc).alias(c))
        elif c in sset:
            out.append(F.when(take_s, sc).alias(c))
        else:
            out.append(tc.alias(c))
    return out


BROADCAST_KEYS_MAX_ROWS = 1_000_000


def apply_changes(target: DataFrame | None, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Merge one deduplicated batch into `target` (M1-M6).

    Rules (t = stored row, s = change row, joined on the primary key):
      only t            -> keep t
      only s            -> insert iff not s._deleted (unseen delete ignored)
      both, s newer     -> hard_delete and s._deleted: drop; else take s
      both, not newer   -> keep t  (out-of-order and replayed events are no-ops)
    On an empty table the batch is inserted minus its deletes.
    """
    changes = changes.drop(*[c for c in INTERNAL if c in changes.columns])
    if target is None:
        return changes.filter(~F.col("_deleted"))
    target = target.drop(*[c for c in INTERNAL if c in target.columns])
    target, changes = _aligned(target, changes)
    pk = list(spec.primary_key)
    return _merge_rows(target, changes, spec, pk)


def _merge_rows(target: DataFrame, changes: DataFrame, spec: TableSpec, pk) -> DataFrame:
    j = _joined(target, changes, spec)
    t, s = F.col("_t"), F.col("_s")
    newer = s.getField("_lsn") > t.getField("_lsn")
    take_s = t.isNull() | (s.isNotNull() & newer)
    keep = F.when(t.isNull(), ~s.getField("_deleted"))
    if spec.hard_delete:
        keep = keep.when(s.isNotNull() & newer & s.getField("_deleted"), F.lit(False))
    keep = keep.otherwise(F.lit(True))
    return j.filter(keep).select(*_project(j, target.columns, changes.columns, pk, take_s))


def fold_changes(state: DataFrame | None, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Order-independent fold (M13). `changes` come from `deduplicate_with_seen`;
    the state keeps tombstones (`_seen = false`); read it through `visible`."""
    changes = with_fingerprint(changes)
    if SEEN not in changes.columns:
        changes = changes.withColumn(SEEN, ~F.col("_deleted"))
    if state is None:
        return changes
    state, changes = _aligned(state, changes)
    pk = list(spec.primary_key)
    return _fold_rows(state, changes, spec, pk)


def _fold_rows(state: DataFrame, changes: DataFrame, spec: TableSpec, pk) -> DataFrame:
    j = _joined(state, changes, spec)
    t, s = F.col("_t"), F.col("_s")
    t_ord = F.struct(*[t.getField(c) for c in ("_lsn", "_event_ts_ms", "_deleted", HASH)])
    s_ord = F.struct(*[s.getField(c) for c in ("_lsn", "_event_ts_ms", "_deleted", HASH)])
    take_s = t.isNull() | (s.isNotNull() & (s_ord > t_ord))
    cols = _project(j, state.columns, changes.columns, pk, take_s)
    seen = (F.coalesce(t.getField(SEEN), F.lit(False)) | F.coalesce(s.getField(SEEN), F.lit(False))).alias(SEEN)
    return j.select(*cols, seen)


def latest_state(changes: DataFrame, spec: TableSpec, partial_columns=None, columns: Sequence[str] | None = None) -> DataFrame:
    """Latest change per key over any number of batches, tombstones kept.

    If the rows carry `_cols` (the payload columns of the batch each row came
    from), a column that some batches lack is taken from the newest row whose
    batch had it (E6); `partial_columns` names those columns when the caller
    knows them (default: every payload column). All other columns come from
    the winning row. One grouped aggregate; its partial stage runs before the
    shuffle. `columns`: those that are wanted beside the key; the order is still
    that of whole changes, but others aren't carried through the sorts and the shuffle.
    """
    changes = with_fingerprint(changes)
    pk = list(spec.primary_key)
    others = [c for c in changes.columns if c not in pk and c not in (SEEN, COLS) and (columns is None or c in columns)]
    seen = F.col(SEEN) if SEEN in changes.columns else ~F.col("_deleted")
    ranked = changes.withColumn(ORD, change_order()).withColumn("_seen_in", seen)
    payload = [c for c in others if not c.startswith("_")]
    if COLS in changes.columns:
        partial = [c for c in payload if partial_columns is None or c in set(partial_columns)]
    else:
        partial = []
    whole = [c for c in others if c not in partial]
    aggs = [F.max_by(F.struct(*[_q(c) for c in whole]), F.col(ORD)).alias("_w")]
    for c in partial:
        lit = c.replace("'", "\\'")
        aggs.append(F.expr(f"max_by(`{c}`, {ORD}) FILTER (WHERE array_contains({COLS}, '{lit}'))").alias(c))
    aggs.append(F.bool_or("_seen_in").alias(SEEN))
    agg = ranked.groupBy(*[_q(c) for c in pk]).agg(*aggs)
    return agg.select(
        *[_q(c) for c in pk],
        *[(F.col(c) if c in partial else F.col("_w").getField(c)).alias(c) for c in others],
        SEEN,
    )


def fold_into(snapshot: DataFrame, log: DataFrame, spec: TableSpec, partial: Sequence[str] = ()) -> DataFrame:
    """The log folded into a snapshot by one join on the key: what ``latest_state`` of both together gives.

    Neither side is grouped with the other, so a snapshot that is bucketed by the
    key stays where it is. A column that some log batches lack (``partial``) comes
    from the newest change that had it, or from the snapshot's row.
    """
    pk = list(spec.primary_key)
    log = with_fingerprint(log).withColumn(ORD, change_order())
    others = [c for c in snapshot.columns if c not in pk and c != SEEN]
    aggs = [F.max_by(F.struct(*[_q(c) for c in others]), F.col(ORD)).alias("_w"), F.max(ORD).alias("_o"), F.bool_or(SEEN).alias("_s")]
    for i, c in enumerate(partial):
        has = f"FILTER (WHERE array_contains({COLS}, '" + c.replace("'", "\\'") + "'))"
        aggs += [F.expr(f"max_by(`{c}`, {ORD}) {has}").alias(f"_v{i}"), F.expr(f"max({ORD}) {has}").alias(f"_o{i}")]
    newest = log.groupBy(*[_q(c) for c in pk]).agg(*aggs)
    stored = snapshot.withColumn(ORD, change_order()).select(*[_q(c) for c in pk], F.struct(*[_q(c) for c in others], SEEN, ORD).alias("_t"))
    t, old = F.col("_t"), F.col("_t").getField(ORD)
    changed = t.isNull() | (F.col("_w").isNotNull() & (F.col("_o") > old))
    out = []
    for c in others:
        if c in partial:
            i = list(partial).index(c)
            later = F.col(f"_o{i}").isNotNull() & (t.isNull() | (F.col(f"_o{i}") > old))
            out.append(F.when(later, F.col(f"_v{i}")).otherwise(t.getField(c)).alias(c))
        else:
            out.append(F.when(changed, F.col("_w").getField(c)).otherwise(t.getField(c)).alias(c))
    seen = F.coalesce(t.getField(SEEN), F.lit(False)) | F.coalesce("_s", F.lit(False))
    return stored.join(newest, pk, "full_outer").select(*[_q(c) for c in pk], *out, seen.alias(SEEN))


def visible(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Hide tombstones (never-seen keys) and, for hard-delete tables, deleted rows."""
    out = state.filter(F.col(SEEN)) if SEEN in state.columns else state
    if spec.hard_delete:
        out = out.filter(~F.col("_deleted"))
    return out.drop(*[c for c in INTERNAL if c in out.columns])


def resolve_latest(changes: DataFrame, spec: TableSpec, partial_columns=None) -> DataFrame:
    """Whole-log, order-independent table state."""
    return visible(latest_state(changes, spec, partial_columns=partial_columns), spec)


def partial_columns(column_sets) -> list[str]:
    """Payload columns that some batch lacks: the only ones that need E6."""
    sets = [{c for c in cols if not c.startswith("_")} for cols in column_sets]
    if not sets:
        return []
    return sorted(set().union(*sets) - set.intersection(*sets))


def stack_batches(batches: list[DataFrame]) -> DataFrame:
    """Union batches with different schemas, remembering each batch's columns
    in `_cols` so `latest_state` can apply E6."""
    tagged = []
    for b in batches:
        payload = [c for c in b.columns if not c.startswith("_")]
        if COLS not in b.columns:
            b = b.withColumn(COLS, F.array(*[F.lit(c) for c in payload]).cast("array<string>"))
        tagged.append(b)
    out = tagged[0]
    for b in tagged[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out
