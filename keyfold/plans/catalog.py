"""Registered queries: every operator of the inventory as a (spark, sf_dir) ->
DataFrame builder over the given tables, with its DuckDB oracle.

Change logs are derived from the base tables by Spark projections
(`keyfold.sources.changelogs`), so each query's work grows with the tables,
and the expected result of each is a closed-form SQL over the same tables.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.money import MONEY
from keyfold.functions.predicates import live
from keyfold.functions.schema import infer_payload_schema
from keyfold.operators import layout
from keyfold.operators.dedupe import collapse_counts, deduplicate_batch
from keyfold.operators.flatten import flatten_changes
from keyfold.operators.history import row_history
from keyfold.operators.merge import apply_changes, stack_batches
from keyfold.operators.reconcile import reconcile, reconcile_by_checksums, table_checksum
from keyfold.plans import analytics as K
from keyfold.plans.maintenance import maintain
from keyfold.plans.pipeline import flattened_batches, fold_in_order, merge_in_order, resolve_log
from keyfold.plans.runner import run_named
from keyfold.session import scratch_dir
from keyfold.sources import changelogs as logs
from keyfold.sources.envelope import KAFKA_SHAPE, classify_records, dead_letters, parse_envelope
from keyfold.sources.files import parsed_topic, read_records, sliced_rows, stage_records, topic, write_records
from keyfold.spec import TableSpec, get_spec
from keyfold.streaming import continuous, expiring, sessions
from keyfold.streaming.sink import StreamConfig, process_batch, start_table_stream
from keyfold.table import ChangeTable, register_views

ORDERS = get_spec("orders")
ITEMS = get_spec("order_items")
INVENTORY = get_spec("inventory")
CUSTOMERS = get_spec("customers")
USERS = TableSpec("user_activity", ("user_id",))

ORDER_COLUMNS = ["order_id", "customer_id", "status", "total_amount", "priority", "_op", "_lsn", "_deleted"]


def _orders_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three orders batches, produced to topic folders once and read back."""
    return [topic(spark, (sf_dir, f"orders-{i}"),
                  lambda i=i: logs.orders_change_batches(spark, sf_dir)[i]) for i in range(3)]


def _orders_parsed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The change rows of the three batches, parsed once."""
    return [parsed_topic(spark, (sf_dir, f"orders-{i}"), lambda i=i: logs.orders_change_batches(spark, sf_dir)[i]) for i in range(3)]


def _orders_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after the three batches, merged in log order (M1)."""
    return merge_in_order(_orders_parsed(spark, sf_dir), ORDERS)


def produce_topics(spark: SparkSession, sf_dir: str) -> None:
    """Produce and parse the derived topics that the queries share."""
    _orders_parsed(spark, sf_dir)
    for log in (_items_log, _inventory_log):
        log(spark, sf_dir)
    _customers_state(spark, sf_dir)
    _user_changes(spark, sf_dir)


def _items_log(spark, sf_dir):
    return parsed_topic(spark, (sf_dir, "order-items"), lambda: logs.order_items_changes(spark, sf_dir))


def _inventory_log(spark, sf_dir):
    return parsed_topic(spark, (sf_dir, "inventory"), lambda: logs.inventory_changes(spark, sf_dir))


#: What the value of an order's lines is made from.
LINE_VALUE = ("order_id", "quantity", "unit_price")


def _items_state(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    return resolve_log([_items_log(spark, sf_dir)], ITEMS, columns)


def _inventory_state(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    return resolve_log([_inventory_log(spark, sf_dir)], INVENTORY, columns)


def _customers_state(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    batches = [parsed_topic(spark, (sf_dir, f"customers-{i}"),
                     lambda i=i: logs.customers_change_batches(spark, sf_dir)[i]) for i in range(2)]
    return resolve_log(batches, CUSTOMERS, columns)


def _orders_log_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole orders log as one unordered set of records."""
    bs = _orders_batches(spark, sf_dir)
    out = bs[0]
    for b in bs[1:]:
        out = out.unionByName(b)
    return out


def _orders_cols(df: DataFrame) -> DataFrame:
    return df.select(*ORDER_COLUMNS)


# ------------------------------------------------------------ envelope / parse


def q_parse_op_types(spark, sf_dir):
    parsed = parse_envelope(_orders_log_union(spark, sf_dir))
    return parsed.groupBy("_op", "_is_snapshot").agg(
        F.count(F.lit(1)).alias("events"), F.min("_lsn").alias("min_lsn"), F.max("_lsn").alias("max_lsn")
    )


def q_tombstones_dropped(spark, sf_dir):
    """Records in, empty values dropped, change rows out: one pass."""
    classified = classify_records(_orders_log_union(spark, sf_dir))
    return classified.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("_reason") == "tombstone").alias("empty_records"),
        F.count_if(F.col("_reason").isNull()).alias("parsed"),
    )


def q_dead_letter_reasons(spark, sf_dir):
    bad = dead_letters(_orders_log_union(spark, sf_dir), primary_key=ORDERS.primary_key)
    return bad.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("records"))


def q_schema_inferred(spark, sf_dir):
    rows = []
    for i, b in enumerate(_orders_batches(spark, sf_dir)):
        schema = infer_payload_schema(parse_envelope(b))
        for f in schema.fields:
            rows.append((i, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "batch long, column_name string, data_type string")


# ------------------------------------------------------------------- dedupe


def _user_changes(spark, sf_dir):
    records = topic(spark, (sf_dir, "user-activity"), lambda: logs.events_changes(spark, sf_dir))
    return flatten_changes(parse_envelope(records), USERS)


def q_dedupe_latest_per_key(spark, sf_dir):
    d = deduplicate_batch(_user_changes(spark, sf_dir), USERS)
    return d.select("user_id", "event_id", "event_type", "value", "ts_ms",
                    F.col("props.k").alias("props_k"), "_lsn", "_op")


def _inventory_changes(spark, sf_dir):
    return flatten_changes(_inventory_log(spark, sf_dir), INVENTORY)


def q_dedupe_composite_key(spark, sf_dir):
    d = deduplicate_batch(_inventory_changes(spark, sf_dir), INVENTORY)
    return d.select("product_id", "warehouse_id", "quantity", "reorder_level", "_lsn", "_op")


def q_collapse_count(spark, sf_dir):
    return collapse_counts(_inventory_changes(spark, sf_dir), INVENTORY)


# -------------------------------------------------------------------- merge


def q_merge_orders_state(spark, sf_dir):
    return _orders_cols(_orders_state(spark, sf_dir))


def q_merge_replay_idempotent(spark, sf_dir):
    bs = _orders_parsed(spark, sf_dir)
    return _orders_cols(merge_in_order(bs, ORDERS, [0, 1, 2, 1, 2, 0]))


def q_merge_out_of_order(spark, sf_dir):
    bs = _orders_parsed(spark, sf_dir)
    return _orders_cols(merge_in_order(bs, ORDERS, [0, 2, 1]))


def q_resolve_any_order(spark, sf_dir):
    # The whole log as one unordered batch.
    return _orders_cols(resolve_log([_orders_log_union(spark, sf_dir)], ORDERS))


def q_fold_any_order(spark, sf_dir):
    bs = _orders_parsed(spark, sf_dir)
    return _orders_cols(fold_in_order(bs, ORDERS, [2, 1, 0]))


def q_fold_rebatched(spark, sf_dir):
    """The log cut into five batches by record hash, folded last to first."""
    raw = _orders_log_union(spark, sf_dir)
    bucket = F.pmod(F.xxhash64("key", "value"), F.lit(5))
    bs = [raw.filter(bucket == i) for i in range(5)]
    return _orders_cols(fold_in_order(bs, ORDERS, [4, 3, 2, 1, 0]))


def q_hard_delete_state(spark, sf_dir):
    """Hard deletes through the order-independent fold: the deleted row's LSN
    survives as a hidden tombstone, so the late batch cannot resurrect it."""
    spec = ORDERS.with_(hard_delete=True)
    return _orders_cols(fold_in_order(_orders_parsed(spark, sf_dir), spec))


def q_hard_delete_in_order(spark, sf_dir):
    """The guarded merge with hard deletes (M4) over batches 0 and 1."""
    spec = ORDERS.with_(hard_delete=True)
    return _orders_cols(merge_in_order(_orders_parsed(spark, sf_dir)[:2], spec))


def q_unseen_delete_ignored(spark, sf_dir):
    st = _orders_state(spark, sf_dir)
    return st.agg(F.count_if(F.col("order_id") < 0).alias("unseen_rows"), F.count(F.lit(1)).alias("rows"))


def q_snapshot_then_live(spark, sf_dir):
    return _orders_state(spark, sf_dir).groupBy("_is_snapshot").agg(F.count(F.lit(1)).alias("rows"))


def q_evolved_column_coverage(spark, sf_dir):
    return K.evolution_coverage(_orders_state(spark, sf_dir), "priority")


def q_customers_tier_coverage(spark, sf_dir):
    return K.evolution_coverage(_customers_state(spark, sf_dir), "loyalty_tier")


def q_row_history(spark, sf_dir):
    flat = flattened_batches(_orders_parsed(spark, sf_dir), ORDERS)
    changes = stack_batches(flat).select("order_id", "_op", "_lsn")
    h = row_history(changes, ORDERS.primary_key)
    return h.select("order_id", "_op", "valid_from_lsn", "valid_to_lsn", "is_current")


# ---------------------------------------------------------- table (log + snapshots)


def _write_orders_table(spark, sf_dir, label: str, path: str | None = None) -> ChangeTable:
    table = ChangeTable(spark, path or scratch_dir(spark, label), ORDERS)
    for rows in _orders_parsed(spark, sf_dir):
        table.append_changes(flatten_changes(rows, ORDERS))
    return table


def q_as_of_commit_0(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "asof")
    return t.read(as_of=0).select("order_id", "customer_id", "status", "total_amount", "_op", "_lsn", "_deleted")


def q_as_of_commit_1(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "asof")
    return _orders_cols(t.read(as_of=1))


def q_table_history(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "history")
    t.optimize()
    return t.history().select(F.col("_commit").alias("version"), F.col("kind").alias("operation"),
                              "events", "deduped")


def q_schema_registry(spark, sf_dir):
    return _write_orders_table(spark, sf_dir, "registry").schema_registry()


def q_ingest_summary(spark, sf_dir):
    return _write_orders_table(spark, sf_dir, "summary").ingest_summary()


def q_sql_views_order_book(spark, sf_dir):
    """Tables registered as SQL views (`orders`, `orders_live`) and queried in SQL."""
    lake = scratch_dir(spark, "views")
    _write_orders_table(spark, sf_dir, "views", path=f"{lake}/orders")
    register_views(spark, lake, [ORDERS, ITEMS])  # order_items is absent: skipped
    return spark.sql(
        "select status, count(*) as orders, cast(sum(cast(total_amount as decimal(18,2))) as decimal(18,2)) "
        "as revenue from orders_live group by status"
    )


def q_commit_applied_counts(spark, sf_dir):
    """Rows merged versus rows that changed the table, per commit (Q6); the
    last commit replays batch 1 and changes nothing."""
    t = _write_orders_table(spark, sf_dir, "applied")
    replay = _orders_batches(spark, sf_dir)[1]
    t.append_changes(flatten_changes(parse_envelope(replay), ORDERS))
    rows = [(c.commit, c.deduped, t.applied_rows(c.commit)) for c in t._meta() if c.kind == "merge"]
    return spark.createDataFrame(rows, "version long, deduped long, applied long")


def q_compaction_preserves_content(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "compact")
    t.optimize(zorder=False)
    return _orders_cols(t.read())


def q_zorder_preserves_content(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "zorder")
    t.optimize(zorder=True)
    t.vacuum(retain_hours=0, allow_short_retention=True)
    return _orders_cols(t.read())


def _twenty_commits(spark, sf_dir) -> list[DataFrame]:
    """The whole orders log cut into twenty batches by LSN, whatever the order of its keys; parsed and dealt once."""
    rows = functools.reduce(DataFrame.unionByName, _orders_parsed(spark, sf_dir))
    return sliced_rows(spark, rows, F.pmod("_lsn", F.lit(20)), 20, "orders")


_LEVELLED: dict[tuple[str, str], ChangeTable] = {}


def _levelled_orders(spark, sf_dir) -> ChangeTable:
    """The log's batches as commits, compacted level by level as they come; made once per application."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _LEVELLED:
        table = ChangeTable(spark, scratch_dir(spark, "levels"), ORDERS)
        for batch in _twenty_commits(spark, sf_dir):
            changes = flatten_changes(batch, ORDERS)
            # one log, one set of columns: a batch without priorities has them as NULL
            table.append_changes(changes if "priority" in changes.columns else changes.withColumn("priority", F.lit(None).cast("string")))
            table.compact(fanout=4)
        _LEVELLED[known] = table
    return _LEVELLED[known]


def q_levelled_compaction_state(spark, sf_dir):
    """Twenty commits, merged into runs as they come (C3): the state is that of the log."""
    return _orders_cols(_levelled_orders(spark, sf_dir).read())


def q_levelled_compaction_runs(spark, sf_dir):
    """Runs per level, the log commits that they hold, and whether a level's runs are larger than the log."""
    table = _levelled_orders(spark, sf_dir)
    log = layout.bytes_under(spark, table.log_path)
    runs = table.commits().where("kind = 'run'")
    size = layout.list_files(spark, table.run_path).select(F.regexp_extract("path", "_commit=([0-9]+)", 1).cast("long").alias("_commit"), "length")
    size = size.groupBy("_commit").agg(F.sum("length").alias("bytes"))
    return runs.join(size, "_commit").groupBy("level").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.col("hi") - F.col("lo") + 1).alias("held"), (F.sum("bytes") <= F.lit(1.1 * log)).alias("within_the_log"))


def _skipping_orders(spark, sf_dir, label: str) -> ChangeTable:
    """The first two batches compacted into many small files, the third on top as a log commit."""
    table = ChangeTable(spark, scratch_dir(spark, label), ORDERS.with_(partition_by=()))
    batches = [flatten_changes(rows, ORDERS) for rows in _orders_parsed(spark, sf_dir)]
    for changes in batches[:2]:
        table.append_changes(changes)
    live = sum(layout.bytes_under(spark, d) for d in table._active_dirs())
    table.optimize(target_file_mb=live / (1 << 20) / 64)
    table.append_changes(batches[2])
    return table


POINT = {"order_id": (42, 42)}
BOX = {"customer_id": (100, 140), "order_id": (1000, None)}


def q_skipping_point(spark, sf_dir):
    """One key, from the files whose zones and z-values can hold it (C4, L4)."""
    return _orders_cols(_skipping_orders(spark, sf_dir, "zones").read_where(POINT))


def q_skipping_box(spark, sf_dir):
    """A range of customers and of orders: the box as ranges of z-values (C4, L4)."""
    return _orders_cols(_skipping_orders(spark, sf_dir, "zones").read_where(BOX))


def q_skipping_files(spark, sf_dir):
    """Per read: files that hold a row of it but weren't chosen, and whether less than half of all files were (C4, M1)."""
    table = _skipping_orders(spark, sf_dir, "zones")
    snapshot = spark.read.parquet(f"{table.snapshot_path}/_commit=2").select("*", F.col("_metadata.file_path").alias("file"))
    keys = snapshot.where("order_id in (1, 7, 42, 1000)").select("order_id").distinct()
    n = snapshot.select("file").distinct().count()

    def row(name: str, chosen: DataFrame, holding: DataFrame) -> DataFrame:
        missed = holding.select("file").distinct().join(chosen, "file", "left_anti")
        under_half = chosen.agg(F.count(F.lit(1)) * 2 < n).scalar()
        return missed.agg(F.lit(name).alias("read"), F.count(F.lit(1)).alias("missed_files")).withColumn("under_half", under_half)

    rows = [row("point", table.files_for(box=POINT), snapshot.where("order_id = 42")),
            row("box", table.files_for(box=BOX), snapshot.where("customer_id between 100 and 140 and order_id >= 1000")),
            row("keys", table.files_for(keys=keys), snapshot.join(keys, "order_id"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def q_bucketed_fold_any_order(spark, sf_dir):
    """Batches last to first into a table bucketed by its key: the snapshot is joined where it lies, twice."""
    spec = ORDERS.with_(partition_by=(), zorder_by=(), buckets=16)
    table = ChangeTable(spark, scratch_dir(spark, "buckets"), spec)
    for rows in reversed(_orders_parsed(spark, sf_dir)):
        table.append_changes(flatten_changes(rows, spec))
        if table.version() in (0, 2):
            table.optimize()
    return _orders_cols(table.read())


def q_rows_of_touched_keys(spark, sf_dir):
    """Stored rows of the keys that the last commit touched, by the Bloom filters of the snapshot's files (M1, M3)."""
    table = _skipping_orders(spark, sf_dir, "touched")
    touched = spark.read.parquet(f"{table.log_path}/_commit=3").select("order_id")
    return _orders_cols(table.rows_of(touched))


def q_sweep_orphans(spark, sf_dir):
    """Directories of writes that were never committed go, what versions read stays."""
    table = _write_orders_table(spark, sf_dir, "sweep")
    table.optimize()
    planted = ["log/_commit=77", "snapshot/_commit=78", "run/_commit=79", "_zones/_commit=80"]
    for place in planted:
        spark.read.parquet(f"{table.log_path}/_commit=0").write.parquet(f"{table.path}/{place}")
    later = int(time.time() * 1000) + 3_600_000
    swept = table.sweep(retain_hours=0, allow_short_retention=True, now_ms=later)
    left = table.unreachable(older_than_ms=later).agg(F.count(F.lit(1)))
    versions = functools.reduce(DataFrame.unionByName, [
        table.read(v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("rows")) for v in (1, 2, 3)])
    return versions.withColumns({"left": left.scalar(), "planted_gone": F.lit(swept == sorted(planted))})


def q_file_stats(spark, sf_dir):
    t = _write_orders_table(spark, sf_dir, "files")
    before = t.data_file_stats().withColumn("stage", F.lit("before"))
    before = spark.createDataFrame(before.collect(), before.schema)  # one row, frozen before rewriting
    t.optimize()
    t.vacuum(retain_hours=0, allow_short_retention=True)
    after = t.data_file_stats().withColumn("stage", F.lit("after"))
    return before.unionByName(after)


# ---------------------------------------------------------------- streaming


def _stream_setup(spark, sf_dir, label):
    root = scratch_dir(spark, label)
    cfg = StreamConfig(lake_root=f"{root}/lake", checkpoint_root=f"{root}/checkpoints",
                       source_root=f"{root}/topics")
    topic_dir = f"{root}/topics/cdc.shop.orders"
    return root, cfg, topic_dir


def _drain(spark, cfg, spec=ORDERS):
    start_table_stream(spark, cfg, spec, once=True).awaitTermination()  # raises if the query fails


def q_stream_drain_state(spark, sf_dir):
    root, cfg, topic_dir = _stream_setup(spark, sf_dir, "stream")
    for b in logs.orders_change_batches(spark, sf_dir):
        write_records(b, topic_dir)
    _drain(spark, cfg)
    return _orders_cols(ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS).read())


def q_stream_bounded_commits(spark, sf_dir):
    """The drained log in commits of at most 5,000 records each (S2): its state."""
    _, cfg, topic_dir = _stream_setup(spark, sf_dir, "bounded")
    cfg = replace(cfg, max_records_per_commit=5_000)
    for batch in _orders_batches(spark, sf_dir):
        write_records(batch, topic_dir)
    _drain(spark, cfg)
    table = cfg.table(spark, ORDERS)
    if table.commits().where("events + coalesce(dropped, 0) > 5000").take(1):
        raise AssertionError("a commit holds more records than allowed")
    return _orders_cols(table.read())


def q_stream_from_latest(spark, sf_dir):
    """A stream that starts at the end of its topic leaves the first two batches out and takes the third (S3)."""
    _, cfg, topic_dir = _stream_setup(spark, sf_dir, "latest")
    cfg = replace(cfg, starting_offsets="latest")
    batches = _orders_batches(spark, sf_dir)
    for batch in batches[:2]:
        write_records(batch, topic_dir)
    _drain(spark, cfg)
    write_records(batches[2], topic_dir)
    _drain(spark, cfg)
    return cfg.table(spark, ORDERS).read().select("order_id", "customer_id", "status", "total_amount", "_op", "_lsn")


def q_stream_restart_state(spark, sf_dir):
    root, cfg, topic_dir = _stream_setup(spark, sf_dir, "stream")
    for b in logs.orders_change_batches(spark, sf_dir):
        write_records(b, topic_dir)
        _drain(spark, cfg)
    _drain(spark, cfg)  # restart on the same checkpoint: nothing new
    return _orders_cols(ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS).read())


def q_stream_fresh_checkpoint_state(spark, sf_dir):
    root, cfg, topic_dir = _stream_setup(spark, sf_dir, "stream")
    for b in logs.orders_change_batches(spark, sf_dir):
        write_records(b, topic_dir)
        _drain(spark, cfg)
    replay = StreamConfig(lake_root=cfg.lake_root, checkpoint_root=f"{root}/checkpoints-fresh",
                          source_root=cfg.source_root)
    _drain(spark, replay)  # full replay from the start: state unchanged
    return _orders_cols(ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS).read())


def _user_stream(spark, sf_dir, root):
    """The user-activity log as a file stream (two files per micro-batch).

    A streaming aggregate needs its payload schema up front: it is inferred
    once from the topic (E1) and pinned (E2)."""
    topic_dir = f"{root}/topics/user_activity"
    write_records(logs.events_changes(spark, sf_dir), topic_dir)
    schema = infer_payload_schema(parse_envelope(read_records(spark, topic_dir)))
    pinned = USERS.with_(schema=schema)
    stream = spark.readStream.schema(KAFKA_SHAPE).option("maxFilesPerTrigger", 2).parquet(topic_dir)
    return flatten_changes(parse_envelope(stream), pinned), pinned


def q_stream_latest_per_key(spark, sf_dir):
    root = scratch_dir(spark, "view")
    changes, spec = _user_stream(spark, sf_dir, root)
    view = continuous.latest_per_key_view(changes, spec)
    q = continuous.start_view(view, f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    out = continuous.read_latest_rows(spark, f"{root}/out", spec.primary_key)
    return out.select("user_id", "event_id", "event_type", "value", "_lsn", "_op")


def q_expiring_latest_per_key(spark, sf_dir):
    """The latest row per user, from state in RocksDB that a silent user leaves after a week."""
    root = scratch_dir(spark, "expiring")
    changes, spec = _user_stream(spark, sf_dir, root)
    with expiring.rocksdb_state(spark):
        continuous.start_view(expiring.latest_per_key_expiring(changes, spec, ttl_ms=7 * 86_400_000), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return continuous.read_latest_rows(spark, f"{root}/out", spec.primary_key).select("user_id", "event_id", "event_type", "value", "_lsn", "_op")


def _drained_in_time(spark, changes: DataFrame, topic_dir: str, drain: Callable[[DataFrame], None]) -> None:
    """The changes written as four sets of files, one stretch of time after the other, the stream drained after each.

    Within a stretch any order goes."""
    changes = changes.withColumn("_at", F.get_json_object("value", "$.ts_ms").cast("long"))
    cuts = changes.agg(F.percentile_approx("_at", [0.25, 0.5, 0.75], 1000)).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = changes.where((F.col("_at") > low) if low is not None else F.lit(True)).where((F.col("_at") <= high) if high is not None else F.lit(True))
        write_records(part, topic_dir)
        drain(spark.readStream.schema(KAFKA_SHAPE).parquet(topic_dir))


def q_windowed_op_counts(spark, sf_dir):
    """Counts per hour over a topic in order of time, as a database log gives it, with a watermark of hours."""
    root = scratch_dir(spark, "window")
    changes = stage_records(spark, logs.events_changes(spark, sf_dir), "window-source")
    schema = infer_payload_schema(parse_envelope(changes))

    def drain(stream: DataFrame) -> None:
        rows = flatten_changes(parse_envelope(stream), USERS.with_(schema=schema))
        view = continuous.windowed_op_counts_view(rows, window="1 hour", watermark="2 hours", group_by="event_type")
        continuous.start_view(view, f"{root}/out", f"{root}/checkpoint").awaitTermination()

    _drained_in_time(spark, changes, f"{root}/topics/user_activity", drain)
    return continuous.read_latest_rows(spark, f"{root}/out", ["window_start_ms", "event_type"])


def q_user_sessions(spark, sf_dir):
    """Sessions of each user, closed by a gap of twelve hours; a heartbeat closes the last ones."""
    root = scratch_dir(spark, "sessions")
    events = logs.events_changes(spark, sf_dir)
    beat = logs.kafka_records(spark.range(1), F.struct(F.lit(-1).alias("user_id")), logs.envelope_value(
        "c", F.lit(0), table="user_activity", after=F.lit('{"user_id":-1}'), ts_ms=F.lit(4_102_444_800_000)), "user_activity", F.lit(-1))
    changes = stage_records(spark, events.unionByName(beat), "sessions-source")
    schema = infer_payload_schema(parse_envelope(changes))

    def drain(stream: DataFrame) -> None:
        rows = flatten_changes(parse_envelope(stream), USERS.with_(schema=schema))
        view = sessions.sessions_view(rows, ["user_id"], gap="12 hours", watermark="2 days")
        with sessions.merged_early(spark):
            continuous.start_view(view, f"{root}/out", f"{root}/checkpoint", mode="append").awaitTermination()

    _drained_in_time(spark, changes, f"{root}/topics/user_activity", drain)
    return spark.read.parquet(f"{root}/out").select("user_id", "session_start_ms", "session_end_ms", "events", "last_lsn")


def q_lag_quantiles(spark, sf_dir):
    """Median and 99th percentile of delivery lags, from the commits' sketches, against the log (K3, T9): whether their ranks are within the bound."""
    table = ChangeTable(spark, scratch_dir(spark, "lags"), ORDERS)
    for rows in _orders_parsed(spark, sf_dir):
        late = F.timestamp_millis(F.col("_event_ts_ms") + (F.col("total_amount") * 10).cast("long"))
        table.append_changes(flatten_changes(rows, ORDERS).withColumn("_ingested_at", late))
    found = table.lag_quantiles((0.5, 0.99))
    log = functools.reduce(DataFrame.unionByName, [flatten_changes(rows, ORDERS).select((F.col("total_amount") * 10).cast("long").alias("lag"))
                                                   for rows in _orders_parsed(spark, sf_dir)]).where("lag is not null")
    n = F.count(F.lit(1))
    parts = [log.agg(F.lit(r.probability).alias("probability"), (
        (F.count_if(F.col("lag") <= r.lag_ms) / n >= r.probability - 0.0035) & (F.count_if(F.col("lag") < r.lag_ms) / n <= r.probability + 0.0035)
    ).alias("within_bound")) for r in found.collect()]
    return functools.reduce(DataFrame.unionByName, parts)


def q_freshness_lag(spark, sf_dir):
    """The longest time from a change at its source to its ingestion (Q13): here up to a second, by LSN."""
    table = ChangeTable(spark, scratch_dir(spark, "lags"), ORDERS)
    for rows in _orders_parsed(spark, sf_dir):
        at = F.timestamp_millis(F.col("_source_ts_ms") + F.col("_lsn") % 977)
        table.append_changes(flatten_changes(rows, ORDERS).withColumn("_ingested_at", at))
    return K.freshness({"orders": table.read()}, with_lag=True).drop("last_write")


# ---------------------------------------------------------------- analytics


def q_order_book_by_status(spark, sf_dir):
    return K.order_book_by_status(_orders_state(spark, sf_dir))


def q_order_line_variance(spark, sf_dir):
    return K.order_line_variance(_orders_state(spark, sf_dir), _items_state(spark, sf_dir, LINE_VALUE))


def q_replenishment_shortfall(spark, sf_dir):
    return K.replenishment_shortfall(_inventory_state(spark, sf_dir))


def q_op_mix(spark, sf_dir):
    return K.op_mix(_orders_state(spark, sf_dir))


def q_op_deleted_mix(spark, sf_dir):
    return K.op_deleted_mix(_orders_state(spark, sf_dir))


def q_freshness_max_lsn(spark, sf_dir):
    return K.freshness({
        "orders": _orders_state(spark, sf_dir),
        "order_items": _items_state(spark, sf_dir, ["_lsn"]),
        "inventory": _inventory_state(spark, sf_dir, ["_lsn"]),
        "customers": _customers_state(spark, sf_dir, ["_lsn"]),
    })


def q_bench_point_lookup_all_rows(spark, sf_dir):
    return _orders_cols(K.bench_point_lookup_all_rows(_orders_state(spark, sf_dir), 42))


def q_bench_range_all_rows(spark, sf_dir):
    return K.bench_range_all_rows(_orders_state(spark, sf_dir), 100, 140)


def q_bench_status_agg(spark, sf_dir):
    return K.bench_status_agg(_orders_state(spark, sf_dir))


def q_bench_join(spark, sf_dir):
    return K.bench_join(_orders_state(spark, sf_dir), _items_state(spark, sf_dir, LINE_VALUE))


def q_bench_low_stock_all_rows(spark, sf_dir):
    return K.bench_low_stock_all_rows(_inventory_state(spark, sf_dir))


def q_bench_full_count_all_rows(spark, sf_dir):
    return K.bench_full_count_all_rows(_items_state(spark, sf_dir))


# ---------------------------------------------------------- reconciliation


def _expected_orders_source(spark, sf_dir) -> DataFrame:
    """The source database's live orders after the workload, from the base table."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    return o.filter(k % 7 != 0).select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(k % 3 == 0, F.lit("shipped")).when(k % 5 == 0, F.lit("stale"))
        .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 3 == 0, F.col("o_totalprice") + 1).when(k % 5 == 0, F.lit(0.5))
        .otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.when(k % 3 == 0, F.col("o_orderpriority")).alias("priority"),
    )


def q_reconcile_clean(spark, sf_dir):
    return reconcile(_orders_state(spark, sf_dir), _expected_orders_source(spark, sf_dir),
                     ORDERS.primary_key, ["customer_id", "status", "total_amount", "priority"])


def _dirty_source(spark, sf_dir) -> DataFrame:
    """The orders before any change: not what the table holds."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_amount"))


def q_reconcile_dirty(spark, sf_dir):
    return reconcile(_orders_state(spark, sf_dir), _dirty_source(spark, sf_dir), ORDERS.primary_key,
                     ["customer_id", "status", "total_amount"])


def q_reconcile_tree_clean(spark, sf_dir):
    """The table against its source by bucket checksums: nothing differs, no row is joined (K6)."""
    return reconcile_by_checksums(_orders_state(spark, sf_dir), _expected_orders_source(spark, sf_dir), ["order_id"], ["customer_id", "status", "total_amount", "priority"])


def q_reconcile_tree_dirty(spark, sf_dir):
    """Against the base table: descends to the buckets that differ (K6, K7)."""
    return reconcile_by_checksums(_orders_state(spark, sf_dir), _dirty_source(spark, sf_dir), ["order_id"], ["customer_id", "status", "total_amount"])


def q_change_feed(spark, sf_dir):
    """Net changes between two versions, with before-images of touched keys only."""
    table = _write_orders_table(spark, sf_dir, "feed")
    table.optimize()
    return table.changes_between(0, 3).select("order_id", "_change", F.col("_before.status").alias("status_before"), F.col("_after.status").alias("status_after"),
                                              F.col("_before.total_amount").alias("amount_before"), F.col("_after.total_amount").alias("amount_after"))


def q_change_feed_roundtrip(spark, sf_dir):
    """The feed from version 0 to 2, applied to the live rows of version 0, gives those of version 2."""
    table = _write_orders_table(spark, sf_dir, "feed")
    live_at = lambda v: live(table.read(v)).select("order_id", "customer_id", "status", "total_amount")
    feed = table.changes_between(0, 2)
    kept = live_at(0).join(feed.select("order_id"), "order_id", "left_anti")
    return kept.unionByName(feed.where("_after is not null").select("_after.order_id", "_after.customer_id", "_after.status", "_after.total_amount"))


def q_table_checksum(spark, sf_dir):
    return table_checksum(_orders_state(spark, sf_dir))


def q_diff_to_changes_roundtrip(spark, sf_dir):
    """Capture old -> new as change records, apply them, get new back (K13 + M1)."""
    bs = _orders_parsed(spark, sf_dir)
    old_state = merge_in_order(bs[:1], ORDERS)
    old = old_state.select("order_id", "customer_id", "status", "total_amount")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    kept = o.filter(k % 7 != 0).select(
        k.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(k % 3 == 0, F.lit("shipped")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("total_amount"))
    added = o.filter(k % 10 == 1).select(
        (k + 10_000_000).alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("pending").alias("status"), F.col("o_totalprice").alias("total_amount"))
    new = kept.unionByName(added)
    records = stage_records(spark, logs.diff_to_changes(
        old, new, ["order_id"], lsn=F.lit(4_000_000_000) + F.abs(F.col("order_id")), table="orders"), "diff")
    changes = flatten_changes(parse_envelope(records), ORDERS)
    state = apply_changes(old_state, deduplicate_batch(changes, ORDERS), ORDERS)
    return live(state).select("order_id", "customer_id", "status", "total_amount")


# ------------------------------------------------ drift, bad input, overlaps


def _order_log(spark, sf_dir, op: str, lsn, where: str = "true", *, label: str, **columns) -> DataFrame:
    """One staged batch of order changes: `columns` replace or add image columns (SQL over the orders table; None: left out)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where(where)
    image = {"order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus", "total_amount": "o_totalprice"} | columns
    body = F.to_json(F.struct(*[F.expr(e).alias(c) for c, e in image.items() if e is not None]), {"ignoreNullFields": "false"})
    value = logs.envelope_value(op, lsn, table="orders", ts_ms=F.lit(logs.SOURCE_TS_BASE), **{"before" if op == "d" else "after": body})
    records = logs.kafka_records(o, F.struct(F.col("o_orderkey").alias("order_id")), value, "orders", F.coalesce(lsn, F.lit(0)))
    return stage_records(spark, records, label)


def _streamed(spark, label: str, batches: list[DataFrame], spec: TableSpec = ORDERS) -> ChangeTable:
    """A table after the batches, each taken as a stream takes it."""
    table = ChangeTable(spark, scratch_dir(spark, label), spec)
    for i, batch in enumerate(batches):
        process_batch(spark, batch, table, query_id=label, batch_id=i)
    return table


def _whole_amounts(spark, sf_dir):
    return _order_log(spark, sf_dir, "r", F.col("o_orderkey"), label="drift", total_amount="bigint(floor(o_totalprice))")


def q_type_drift_widened(spark, sf_dir):
    """Whole amounts first, fractions later: the column becomes double and loses nothing (E5)."""
    later = _order_log(spark, sf_dir, "u", F.col("o_orderkey") + 2_000_000_000, "o_orderkey % 3 = 0", label="drift", total_amount="o_totalprice + 0.25D")
    return _streamed(spark, "drift", [_whole_amounts(spark, sf_dir), later]).read().select("order_id", "total_amount")


def q_type_drift_to_string(spark, sf_dir):
    """Whole amounts first, text later: the column becomes text (E5)."""
    later = _order_log(spark, sf_dir, "u", F.col("o_orderkey") + 2_000_000_000, "o_orderkey % 3 = 0", label="drift", total_amount="'n/a'")
    return _streamed(spark, "drift", [_whole_amounts(spark, sf_dir), later]).read().select("order_id", "total_amount")


def q_bad_key_dead_letters(spark, sf_dir):
    """Text keys for a table keyed by integers are dead letters, and no row is merged away."""
    later = _order_log(spark, sf_dir, "u", F.col("o_orderkey") + 2_000_000_000, "o_orderkey % 31 = 0", label="keys", order_id="concat('X', o_orderkey)")
    table = _streamed(spark, "keys", [_whole_amounts(spark, sf_dir), later])
    bad = spark.read.parquet(f"{table.path}/dead_letters").groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("records"))
    return bad.unionByName(table.read().groupBy(F.lit("(table)").alias("reason")).agg(F.count("*").alias("records")))


class _Overtaken(ChangeTable):
    """A table whose next commit row comes after another writer's commit."""

    def __init__(self, table: ChangeTable, late: DataFrame):
        super().__init__(table.spark, table.path, table.spec)
        self.late: DataFrame | None = late

    def _write_commit(self, info: dict) -> None:
        late, self.late = self.late, None
        if late is not None:
            ChangeTable(self.spark, self.path, self.spec).append_changes(flatten_changes(parse_envelope(late), self.spec))
        super()._write_commit(info)


def q_optimize_during_stream(spark, sf_dir):
    """A commit between the fold and the publication of a snapshot is kept, also through the next compaction and a vacuum."""
    first, second, late = _orders_batches(spark, sf_dir)
    table = _streamed(spark, "overlap", [first, second])
    _Overtaken(table, late).optimize()
    again = ChangeTable(spark, table.path, ORDERS)
    again.optimize()
    again.vacuum(retain_hours=0, allow_short_retention=True)
    return _orders_cols(again.read())


def q_stream_with_bad_batches(spark, sf_dir):
    """Batches of tombstones only, of NULL keys only and without the key column come between good ones; the stream goes on (M7)."""
    _, cfg, topic_dir = _stream_setup(spark, sf_dir, "bad-batches")
    first, second, late = _orders_batches(spark, sf_dir)
    lsn = F.col("o_orderkey") + 6_000_000_000
    no_key = _order_log(spark, sf_dir, "c", lsn, "o_orderkey % 9 = 0", label="bad", order_id=None)
    null_key = _order_log(spark, sf_dir, "c", lsn, "o_orderkey % 9 = 1", label="bad", order_id="cast(null as bigint)")
    for batch in (first, first.withColumn("value", F.lit(None).cast("string")), null_key, second, no_key, late):
        write_records(batch, topic_dir)
        _drain(spark, cfg)
    return _orders_cols(ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS).read())


def q_empty_partition_value_kept(spark, sf_dir):
    """An empty string in a partition column reads back as it was after compaction."""
    table = _streamed(spark, "blank", [_order_log(spark, sf_dir, "r", F.col("o_orderkey"), label="blank",
                                                  status="case when o_orderkey % 2 = 0 then '' when o_orderkey % 3 = 0 then null else o_orderstatus end")])
    table.optimize()
    return table.read().select("order_id", "status")


def q_delete_wins_tie(spark, sf_dir):
    """An update and a delete at one LSN and event time: the delete wins."""
    lsn = F.col("o_orderkey")
    both = _order_log(spark, sf_dir, "u", lsn, label="tie").unionByName(_order_log(spark, sf_dir, "d", lsn, "o_orderkey % 3 = 0", label="tie"))
    return deduplicate_batch(flatten_changes(parse_envelope(both), ORDERS), ORDERS).select("order_id", "_op", "_deleted")


def q_exact_tie_is_stable(spark, sf_dir):
    """Two updates alike in everything but their image: the same one wins in either order."""
    lsn = F.col("o_orderkey")
    a = _order_log(spark, sf_dir, "u", lsn, label="tie", status="'a'")
    b = _order_log(spark, sf_dir, "u", lsn, label="tie", status="'b'")
    one, two = (deduplicate_batch(flatten_changes(parse_envelope(x), ORDERS), ORDERS).select("order_id", "status")
                for x in (a.unionByName(b), b.unionByName(a)))
    return one.join(two, ["order_id", "status"]).agg(F.count("*").alias("agreeing"))


def q_lsn_default(spark, sf_dir):
    """Without an LSN a change has LSN 0 (P5), and its key is kept as text."""
    parsed = parse_envelope(_order_log(spark, sf_dir, "c", F.lit(None).cast("long"), label="lsn"))
    return parsed.select("_key", "_lsn")


def q_absent_column_kept(spark, sf_dir):
    """A later batch without the priority column wins the row but keeps its priority."""
    first, second, _ = _orders_batches(spark, sf_dir)
    later = _order_log(spark, sf_dir, "u", F.col("o_orderkey") + 7_000_000_000, "o_orderkey % 3 = 0 and o_orderkey % 7 <> 0", label="absent", status="'done'")
    table = _streamed(spark, "absent", [first, second, later])
    return table.read().where("status = 'done'").select("order_id", "status", "priority")


def q_file_counts(spark, sf_dir):
    """Directories that the current version reads: one per commit, then the snapshot."""
    table = _write_orders_table(spark, sf_dir, "dirs")
    holds = lambda stage: table.active_files().select(F.regexp_extract("path", "/(log|snapshot)/_commit=([0-9]+)/", 0).alias("d")).agg(
        F.lit(stage).alias("stage"), F.count_distinct("d").alias("directories"))
    before = holds("before")
    before = spark.createDataFrame(before.collect(), before.schema)  # one row, frozen before the rewrite
    table.optimize()
    return before.unionByName(holds("after"))


def q_maintenance_result(spark, sf_dir):
    """Maintenance of a lake where one table exists: its row, with files saved and content kept."""
    lake = scratch_dir(spark, "maintained")
    table = _write_orders_table(spark, sf_dir, "maintained", path=f"{lake}/orders")
    result = maintain(spark, lake, [ORDERS, ITEMS], retain_hours=0, allow_short_retention=True)
    rows = table.read().agg(F.count("*").alias("rows"))
    return result.select("table_name", F.array_join("zordered_by", ",").alias("zordered_by")).join(
        rows.withColumn("table_name", F.lit("orders")), "table_name")


def q_named_runner(spark, sf_dir):
    """A named set goes on past a query that fails."""
    state = _orders_state(spark, sf_dir)
    ran = run_named({"status_agg": lambda: K.bench_status_agg(state), "broken": lambda: state.select("no_such_column"),
                     "op_mix": lambda: K.op_mix(state)})
    return spark.createDataFrame([(name, "error" in r, len(r.get("rows", []))) for name, r in ran.items()], "name string, failed boolean, shown int")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# ---------------------------------------------------------------- oracles

ORDERS_EXPECTED = """
select o_orderkey as order_id, o_custkey as customer_id,
  case when o_orderkey%7=0 then null when o_orderkey%3=0 then o_orderpriority end as priority,
  case when o_orderkey%7=0 then o_orderstatus when o_orderkey%3=0 then 'shipped'
       when o_orderkey%5=0 then 'stale' else o_orderstatus end as status,
  case when o_orderkey%7=0 then o_totalprice when o_orderkey%3=0 then o_totalprice+1
       when o_orderkey%5=0 then 0.5 else o_totalprice end as total_amount,
  case when o_orderkey%7=0 then 'd' when o_orderkey%3=0 or o_orderkey%5=0 then 'u' else 'r' end as _op,
  case when o_orderkey%7=0 then 3000000000+o_orderkey when o_orderkey%3=0 then 2000000000+o_orderkey
       when o_orderkey%5=0 then 1000000000+o_orderkey else o_orderkey+1 end as _lsn,
  o_orderkey%7=0 as _deleted,
  not (o_orderkey%7=0 or o_orderkey%3=0 or o_orderkey%5=0) as _is_snapshot
from orders
"""

ORDER_COLS_SQL = "order_id, customer_id, status, total_amount, priority, _op, _lsn, _deleted"

STATE = f"select {ORDER_COLS_SQL} from ({ORDERS_EXPECTED}) s"

ORDER_EVENTS = """
select o_orderkey as order_id, 'r' as _op, true as _is_snapshot, o_orderkey+1 as _lsn from orders
union all select o_orderkey, 'u', false, 2000000000+o_orderkey from orders where o_orderkey%3=0
union all select o_orderkey, 'd', false, 3000000000+o_orderkey from orders where o_orderkey%7=0
union all select -o_orderkey-1, 'd', false, 3000000000+o_orderkey from orders where o_orderkey%11=0
union all select o_orderkey, 'u', false, 1000000000+o_orderkey from orders where o_orderkey%5=0
"""

USERS_LATEST = """
select user_id, event_id, event_type, value, epoch_us(ts) // 1000 as ts_ms,
       cast(json_extract(props, '$.k') as bigint) as props_k, event_id as _lsn, 'c' as _op
from events qualify row_number() over (partition by user_id order by event_id desc) = 1
"""

INVENTORY_LATEST = """
select l_partkey as product_id, l_suppkey as warehouse_id, cast(l_quantity as bigint) as quantity,
       cast(25 as bigint) as reorder_level, l_orderkey*10 + l_linenumber as _lsn,
       case when l_linenumber = 1 then 'r' else 'u' end as _op, false as _deleted
from lineitem
qualify row_number() over (partition by l_partkey, l_suppkey
                           order by l_orderkey*10 + l_linenumber desc, l_shipdate desc) = 1
"""

MONEY_SQL = f"cast({{x}} as {MONEY})"


def _money(x: str) -> str:
    return MONEY_SQL.format(x=x)


def _avg_money(x: str) -> str:
    cents = f"cast({_money(x)} * 100 as bigint)"
    return f"cast(floor((sum({cents}) * 2 + count({x})) / (count({x}) * 2)) / 100 as {MONEY})"


ORACLE: dict[str, str] = {
    "parse_op_types": f"""
        with ev as ({ORDER_EVENTS}
          union all select null, 'c', false, 5000000000+o_orderkey from orders where o_orderkey%29=0)
        select _op, _is_snapshot, count(*) as events, min(_lsn) as min_lsn, max(_lsn) as max_lsn
        from ev group by _op, _is_snapshot""",
    "tombstones_dropped": """
        select count(*) + count(*) filter (where o_orderkey%3=0) + 2*count(*) filter (where o_orderkey%7=0)
             + 2*count(*) filter (where o_orderkey%11=0) + count(*) filter (where o_orderkey%13=0)
             + count(*) filter (where o_orderkey%17=0) + count(*) filter (where o_orderkey%19=0)
             + count(*) filter (where o_orderkey%23=0) + count(*) filter (where o_orderkey%29=0)
             + count(*) filter (where o_orderkey%5=0) as records,
             count(*) filter (where o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0)
             + count(*) filter (where o_orderkey%17=0) as empty_records,
             count(*) + count(*) filter (where o_orderkey%3=0) + count(*) filter (where o_orderkey%7=0)
             + count(*) filter (where o_orderkey%11=0) + count(*) filter (where o_orderkey%29=0)
             + count(*) filter (where o_orderkey%5=0) as parsed
        from orders""",
    "dead_letter_reasons": """
        select reason, records from (
          select 'tombstone' as reason, count(*) filter (where o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0)
                 + count(*) filter (where o_orderkey%17=0) as records from orders
          union all select 'malformed', count(*) from orders where o_orderkey%13=0
          union all select 'truncate', count(*) from orders where o_orderkey%19=0
          union all select 'no_image', count(*) from orders where o_orderkey%23=0
          union all select 'null_key', count(*) from orders where o_orderkey%29=0
        ) r where records > 0""",
    "schema_inferred": """
        select cast(batch as bigint) as batch, column_name, data_type from (values
          (0, 'customer_id', 'bigint'), (0, 'order_id', 'bigint'), (0, 'status', 'string'),
          (0, 'total_amount', 'double'),
          (1, 'customer_id', 'bigint'), (1, 'order_id', 'bigint'), (1, 'priority', 'string'),
          (1, 'status', 'string'), (1, 'total_amount', 'double'),
          (2, 'customer_id', 'bigint'), (2, 'order_id', 'bigint'), (2, 'status', 'string'),
          (2, 'total_amount', 'double')) t(batch, column_name, data_type)""",
    "dedupe_latest_per_key": USERS_LATEST,
    "dedupe_composite_key": f"select product_id, warehouse_id, quantity, reorder_level, _lsn, _op from ({INVENTORY_LATEST}) i",
    "collapse_count": """
        select count(*) as events, count(distinct (l_partkey, l_suppkey)) as deduped,
               count(*) - count(distinct (l_partkey, l_suppkey)) as collapsed from lineitem""",
    "merge_orders_state": STATE,
    "merge_replay_idempotent": STATE,
    "merge_out_of_order": STATE,
    "resolve_any_order": STATE,
    "fold_any_order": STATE,
    "fold_rebatched": STATE,
    "hard_delete_state": f"{STATE} where not _deleted",
    "hard_delete_in_order": """
        select o_orderkey as order_id, o_custkey as customer_id,
          case when o_orderkey%3=0 then 'shipped' else o_orderstatus end as status,
          case when o_orderkey%3=0 then o_totalprice+1 else o_totalprice end as total_amount,
          case when o_orderkey%3=0 then o_orderpriority end as priority,
          case when o_orderkey%3=0 then 'u' else 'r' end as _op,
          case when o_orderkey%3=0 then 2000000000+o_orderkey else o_orderkey+1 end as _lsn,
          false as _deleted
        from orders where o_orderkey%7<>0""",
    "unseen_delete_ignored": "select cast(0 as bigint) as unseen_rows, count(*) as rows from orders",
    "snapshot_then_live": f"select _is_snapshot, count(*) as rows from ({ORDERS_EXPECTED}) s group by _is_snapshot",
    "evolved_column_coverage": f"""
        select coalesce(priority, '(not set)') as priority, count(*) as rows
        from ({ORDERS_EXPECTED}) s where not _deleted group by 1""",
    "customers_tier_coverage": """
        select case when c_custkey%4=0 then (case when c_acctbal > 5000 then 'gold' else 'silver' end)
                    else '(not set)' end as loyalty_tier, count(*) as rows
        from customer group by 1""",
    "row_history": f"""
        select order_id, _op, _lsn as valid_from_lsn,
               lead(_lsn) over (partition by order_id order by _lsn) as valid_to_lsn,
               lead(_lsn) over (partition by order_id order by _lsn) is null as is_current
        from ({ORDER_EVENTS}) e""",
    "as_of_commit_0": """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status,
               o_totalprice as total_amount, 'r' as _op, o_orderkey+1 as _lsn, false as _deleted
        from orders""",
    "as_of_commit_1": """
        select o_orderkey as order_id, o_custkey as customer_id,
          case when o_orderkey%7<>0 and o_orderkey%3=0 then 'shipped' else o_orderstatus end as status,
          case when o_orderkey%7<>0 and o_orderkey%3=0 then o_totalprice+1 else o_totalprice end as total_amount,
          case when o_orderkey%7<>0 and o_orderkey%3=0 then o_orderpriority end as priority,
          case when o_orderkey%7=0 then 'd' when o_orderkey%3=0 then 'u' else 'r' end as _op,
          case when o_orderkey%7=0 then 3000000000+o_orderkey when o_orderkey%3=0 then 2000000000+o_orderkey
               else o_orderkey+1 end as _lsn,
          o_orderkey%7=0 as _deleted
        from orders""",
    "table_history": """
        select cast(0 as bigint) as version, 'merge' as operation, count(*) as events, count(*) as deduped from orders
        union all
        select 1, 'merge',
               count(*) filter (where o_orderkey%3=0) + count(*) filter (where o_orderkey%7=0)
                 + count(*) filter (where o_orderkey%11=0),
               count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0)
        from orders
        union all select 2, 'merge', count(*), count(*) from orders where o_orderkey%5=0
        union all select 3, 'optimize', null, null""",
    "schema_registry": """
        select * from (values ('customer_id', 'bigint', cast(0 as bigint)), ('order_id', 'bigint', 0),
          ('status', 'string', 0), ('total_amount', 'double', 0), ('priority', 'string', 1))
        t(column_name, data_type, first_commit)""",
    "ingest_summary": """
        select 'orders' as table_name, cast(3 as bigint) as commits,
               count(*) + count(*) filter (where o_orderkey%3=0) + count(*) filter (where o_orderkey%7=0)
                 + count(*) filter (where o_orderkey%11=0) + count(*) filter (where o_orderkey%5=0) as events,
               count(*) + count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0)
                 + count(*) filter (where o_orderkey%11=0) + count(*) filter (where o_orderkey%5=0) as rows_merged,
               count(*) filter (where o_orderkey%3=0) + count(*) filter (where o_orderkey%7=0)
                 - count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0) as collapsed
        from orders""",
    "sql_views_order_book": f"""
        select status, count(*) as orders, cast(sum({_money('total_amount')}) as {MONEY}) as revenue
        from ({ORDERS_EXPECTED}) s where not _deleted group by status""",
    "commit_applied_counts": """
        select cast(0 as bigint) as version, count(*) as deduped, count(*) as applied from orders
        union all
        select 1,
               count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0),
               count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0)
        from orders
        union all
        select 2, count(*) filter (where o_orderkey%5=0),
               count(*) filter (where o_orderkey%5=0 and o_orderkey%3<>0 and o_orderkey%7<>0)
        from orders
        union all
        select 3,
               count(*) filter (where o_orderkey%3=0 or o_orderkey%7=0) + count(*) filter (where o_orderkey%11=0),
               cast(0 as bigint)
        from orders""",
    "compaction_preserves_content": STATE,
    "zorder_preserves_content": STATE,
    "levelled_compaction_state": STATE,
    "levelled_compaction_runs": """
        select cast(level as bigint) as level, cast(runs as bigint) as runs, cast(held as bigint) as held, true as within_the_log
        from (values (1, 5, 20), (2, 1, 19)) r(level, runs, held)""",
    "skipping_point": f"{STATE} where order_id = 42",
    "skipping_box": f"{STATE} where customer_id between 100 and 140 and order_id >= 1000",
    "skipping_files": "select read, cast(0 as bigint) as missed_files, true as under_half from (values ('point'), ('box'), ('keys')) r(read)",
    "rows_of_touched_keys": f"{STATE} where order_id % 5 = 0",
    "bucketed_fold_any_order": STATE,
    "sweep_orphans": """
        select cast(v as bigint) as version, (select count(*) from orders) as rows, cast(0 as bigint) as left, true as planted_gone
        from (values (1), (2), (3)) r(v)""",
    "stream_drain_state": STATE,
    "stream_bounded_commits": STATE,
    "stream_from_latest": """
        select o_orderkey as order_id, o_custkey as customer_id, 'stale' as status, cast(0.5 as double) as total_amount, 'u' as _op, 1000000000+o_orderkey as _lsn
        from orders where o_orderkey%5=0""",
    "stream_restart_state": STATE,
    "stream_fresh_checkpoint_state": STATE,
    "stream_latest_per_key": f"select user_id, event_id, event_type, value, _lsn, _op from ({USERS_LATEST}) u",
    "expiring_latest_per_key": f"select user_id, event_id, event_type, value, _lsn, _op from ({USERS_LATEST}) u",
    "user_sessions": """
        with e as (select user_id, event_id, epoch_us(ts) // 1000 as t from events),
        s as (select *, case when t - lag(t) over (partition by user_id order by t, event_id) <= 43200000 then 0 else 1 end as new from e),
        n as (select *, sum(new) over (partition by user_id order by t, event_id rows unbounded preceding) as session from s)
        select user_id, min(t) as session_start_ms, max(t) as session_end_ms, count(*) as events, max(event_id) as last_lsn
        from n group by user_id, session""",
    "freshness_lag": f"select 'orders' as table_name, max(_lsn) as max_lsn, max(_lsn % 977) / 1000 as max_lag_seconds from ({ORDERS_EXPECTED}) s",
    "lag_quantiles": "select probability, true as within_bound from (values (cast(0.5 as double)), (cast(0.99 as double))) r(probability)",
    "windowed_op_counts": """
        select epoch_ms(date_trunc('hour', ts)) as window_start_ms, event_type, count(*) as events
        from events group by all""",
    "order_book_by_status": f"""
        select status, count(*) as orders, cast(sum({_money('total_amount')}) as {MONEY}) as revenue,
               {_avg_money('total_amount')} as avg_order_value
        from ({ORDERS_EXPECTED}) s where not _deleted group by status""",
    "order_line_variance": f"""
        with o as ({ORDERS_EXPECTED}),
        v as (
          select o.order_id, o.status, o.total_amount, count(*) as line_count,
                 cast(sum(cast(l_quantity as bigint) * {_money('l_extendedprice')}) as {MONEY}) as computed_total,
                 cast({_money('o.total_amount')} - sum(cast(l_quantity as bigint) * {_money('l_extendedprice')}) as {MONEY}) as variance
          from o join lineitem l on o.order_id = l.l_orderkey
          where not o._deleted and l.l_orderkey % 7 <> 0
          group by o.order_id, o.status, o.total_amount)
        select * from v where abs(variance) > 0.01 order by abs(variance) desc, order_id limit 20""",
    "replenishment_shortfall": f"""
        select product_id, warehouse_id, quantity, reorder_level, reorder_level - quantity as shortfall
        from ({INVENTORY_LATEST}) i where quantity < reorder_level
        order by shortfall desc, product_id, warehouse_id limit 25""",
    "op_mix": f"""
        select _op, count(*) as event_rows, count(*) filter (where _deleted) as deleted_rows
        from ({ORDERS_EXPECTED}) s group by _op""",
    "op_deleted_mix": f"select _op, _deleted, count(*) as rows from ({ORDERS_EXPECTED}) s group by _op, _deleted",
    "freshness_max_lsn": f"""
        select 'customers' as table_name, max(case when c_custkey%4=0 then 1000000000+c_custkey else c_custkey+1 end) as max_lsn from customer
        union all select 'inventory', max(l_orderkey*10 + l_linenumber) from lineitem
        union all select 'order_items', max(case when l_orderkey%7=0 then 3000000000+l_orderkey else l_orderkey*10 + l_linenumber end) from lineitem
        union all select 'orders', max(_lsn) from ({ORDERS_EXPECTED}) s""",
    "bench_point_lookup_all_rows": f"{STATE} where order_id = 42",
    "bench_range_all_rows": f"select order_id, status, total_amount from ({ORDERS_EXPECTED}) s where customer_id between 100 and 140",
    "bench_status_agg": f"""
        select status, count(*) as orders, cast(sum({_money('total_amount')}) as {MONEY}) as revenue
        from ({ORDERS_EXPECTED}) s where not _deleted group by status""",
    "bench_join": f"""
        select o.status, count(*) as lines,
               cast(sum(cast(l_quantity as bigint) * {_money('l_extendedprice')}) as {MONEY}) as value
        from ({ORDERS_EXPECTED}) o join lineitem l on o.order_id = l.l_orderkey
        where not o._deleted and l.l_orderkey % 7 <> 0 group by o.status""",
    "bench_low_stock_all_rows": f"""
        select product_id, warehouse_id, quantity, reorder_level from ({INVENTORY_LATEST}) i
        where quantity < reorder_level""",
    "bench_full_count_all_rows": "select count(*) as rows from lineitem",
    "reconcile_clean": """
        select count(*) filter (where o_orderkey%7<>0) as source_rows,
               count(*) filter (where o_orderkey%7<>0) as live_rows,
               count(*) filter (where o_orderkey%7=0) as deleted_rows,
               cast(0 as bigint) as missing_rows, cast(0 as bigint) as extra_rows,
               cast(0 as bigint) as mismatched_rows, cast(0 as bigint) as mismatch_customer_id,
               cast(0 as bigint) as mismatch_status, cast(0 as bigint) as mismatch_total_amount,
               cast(0 as bigint) as mismatch_priority
        from orders""",
    "reconcile_tree_clean": """
        select count(*) filter (where o_orderkey%7<>0) as source_rows,
               count(*) filter (where o_orderkey%7<>0) as live_rows,
               count(*) filter (where o_orderkey%7=0) as deleted_rows,
               cast(0 as bigint) as missing_rows, cast(0 as bigint) as extra_rows,
               cast(0 as bigint) as mismatched_rows, cast(0 as bigint) as mismatch_customer_id,
               cast(0 as bigint) as mismatch_status, cast(0 as bigint) as mismatch_total_amount,
               cast(0 as bigint) as mismatch_priority
        from orders""",
    "reconcile_dirty": """
        select count(*) as source_rows,
               count(*) filter (where o_orderkey%7<>0) as live_rows,
               count(*) filter (where o_orderkey%7=0) as deleted_rows,
               count(*) filter (where o_orderkey%7=0) as missing_rows,
               cast(0 as bigint) as extra_rows,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatched_rows,
               cast(0 as bigint) as mismatch_customer_id,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatch_status,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatch_total_amount
        from orders""",
    "reconcile_tree_dirty": """
        select count(*) as source_rows,
               count(*) filter (where o_orderkey%7<>0) as live_rows,
               count(*) filter (where o_orderkey%7=0) as deleted_rows,
               count(*) filter (where o_orderkey%7=0) as missing_rows,
               cast(0 as bigint) as extra_rows,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatched_rows,
               cast(0 as bigint) as mismatch_customer_id,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatch_status,
               count(*) filter (where o_orderkey%7<>0 and (o_orderkey%3=0 or o_orderkey%5=0)) as mismatch_total_amount
        from orders""",
    "change_feed": f"""
        with v0 as (select o_orderkey as order_id, o_orderstatus as status, o_totalprice as total_amount from orders),
        v3 as (select order_id, status, total_amount from ({ORDERS_EXPECTED}) s where not _deleted)
        select v0.order_id, case when v3.order_id is null then 'delete' else 'update' end as _change, v0.status as status_before,
               v3.status as status_after, v0.total_amount as amount_before, v3.total_amount as amount_after
        from v0 left join v3 on v3.order_id = v0.order_id
        where v3.order_id is null or v0.status <> v3.status or v0.total_amount <> v3.total_amount
              or v0.order_id in (select order_id from ({ORDERS_EXPECTED}) s where priority is not null)""",
    "change_feed_roundtrip": f"select order_id, customer_id, status, total_amount from ({ORDERS_EXPECTED}) s where not _deleted",
    "table_checksum": f"select count(*) as rows, cast(sum(_lsn) as bigint) as lsn_sum from ({ORDERS_EXPECTED}) s",
    "diff_to_changes_roundtrip": """
        select o_orderkey as order_id, o_custkey as customer_id,
               case when o_orderkey%3=0 then 'shipped' else o_orderstatus end as status,
               o_totalprice as total_amount
        from orders where o_orderkey%7<>0
        union all
        select o_orderkey + 10000000, o_custkey, 'pending', o_totalprice from orders where o_orderkey%10=1""",
}

ORACLE |= {
    "type_drift_widened": """
        select o_orderkey as order_id, case when o_orderkey%3=0 then o_totalprice + 0.25 else floor(o_totalprice) end::double as total_amount
        from orders""",
    "type_drift_to_string": """
        select o_orderkey as order_id, case when o_orderkey%3=0 then 'n/a' else cast(floor(o_totalprice)::bigint as varchar) end as total_amount
        from orders""",
    "bad_key_dead_letters": """
        select 'bad_key' as reason, count(*) as records from orders where o_orderkey%31=0 having count(*) > 0
        union all select '(table)', count(*) from orders""",
    "optimize_during_stream": STATE,
    "stream_with_bad_batches": STATE,
    "empty_partition_value_kept": """
        select o_orderkey as order_id, case when o_orderkey%2=0 then '' when o_orderkey%3=0 then null else o_orderstatus end as status
        from orders""",
    "delete_wins_tie": """
        select o_orderkey as order_id, case when o_orderkey%3=0 then 'd' else 'u' end as _op, o_orderkey%3=0 as _deleted from orders""",
    "exact_tie_is_stable": "select count(*) as agreeing from orders",
    "lsn_default": """select '{"order_id":' || o_orderkey || '}' as _key, cast(0 as bigint) as _lsn from orders""",
    "absent_column_kept": """
        select o_orderkey as order_id, 'done' as status, o_orderpriority as priority from orders
        where o_orderkey%3=0 and o_orderkey%7<>0""",
    "file_counts": "select 'before' as stage, cast(3 as bigint) as directories union all select 'after', 1",
    "maintenance_result": "select 'orders' as table_name, 'customer_id,order_id' as zordered_by, count(*) as rows from orders",
    "named_runner": f"""
        select 'status_agg' as name, false as failed, cast(count(distinct status) as int) as shown from ({ORDERS_EXPECTED}) s where not _deleted
        union all select 'broken', true, 0
        union all select 'op_mix', false, cast(count(distinct _op) as int) from ({ORDERS_EXPECTED}) s""",
}

# Queries whose result is not expressible as SQL over the base tables
# (file counts depend on the writer): rows-only check.
NO_ORACLE = {"file_stats"}
