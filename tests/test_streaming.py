from pyspark.sql import functions as F

from changes_data import event, order
from keyfold.session import scratch_dir
from keyfold.sources.envelope import KAFKA_SHAPE, parse_envelope
from keyfold.sources.files import write_records
from keyfold.operators.flatten import flatten_changes
from keyfold.spec import TableSpec, get_spec
from keyfold.streaming import continuous
from keyfold.streaming import sink
from keyfold.streaming.sink import ProgressRecorder, StreamConfig, ingested, numbered, process_batch, process_slices, run_streams, slices, start_table_stream
from keyfold.table import ChangeTable

ORDERS = get_spec("orders")


def records(spark, recs, topic="orders"):
    rows = [(k, v, topic, 0, i, 0) for i, (k, v) in enumerate(recs)]
    return spark.createDataFrame(rows, KAFKA_SHAPE)


def setup(spark):
    root = scratch_dir(spark, "stream")
    cfg = StreamConfig(lake_root=f"{root}/lake", checkpoint_root=f"{root}/ck", source_root=f"{root}/src")
    return root, cfg, f"{root}/src/cdc.shop.orders"


def drain(spark, cfg, spec=ORDERS):
    """Run one table's stream to its end; what it has ingested over all its runs."""
    query = start_table_stream(spark, cfg, spec, once=True)
    query.awaitTermination()
    mine = ingested(spark, cfg, [spec]).filter(f"query_id = '{query.id}'").collect()
    return mine[0] if mine else None


def state(spark, cfg):
    t = ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS)
    return sorted((r["order_id"], r["status"], r["_deleted"]) for r in t.read().collect())


def test_drain_restart_and_fresh_checkpoint(spark):
    root, cfg, topic = setup(spark)
    write_records(records(spark, [("1", event("c", 1, order(1))),
                                  ("2", event("c", 2, order(2)))]), topic)
    h = drain(spark, cfg)
    assert h.events == 2
    write_records(records(spark, [("1", event("u", 3, order(1, "paid"))),
                                  ("2", event("d", 4, order(2))), ("2", None)]), topic)
    h = drain(spark, cfg)
    expected = [(1, "paid", False), (2, "new", True)]
    assert state(spark, cfg) == expected
    # restart on the same checkpoint: nothing reprocessed
    again = drain(spark, cfg)
    assert again == h and again.events == 4
    # full replay with a fresh checkpoint: state unchanged
    fresh = StreamConfig(lake_root=cfg.lake_root, checkpoint_root=f"{root}/ck-fresh", source_root=cfg.source_root)
    replay = drain(spark, fresh)
    assert replay.events == 4
    assert state(spark, cfg) == expected
    assert sum(r.events for r in ingested(spark, fresh, [ORDERS]).collect()) == 8


def test_schema_evolves_mid_stream(spark):
    root, cfg, topic = setup(spark)
    write_records(records(spark, [("1", event("c", 1, order(1)))]), topic)
    drain(spark, cfg)
    write_records(records(spark, [("2", event("c", 2, order(2, priority="high")))]), topic)
    drain(spark, cfg)
    t = ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS)
    got = sorted((r["order_id"], r["priority"]) for r in t.read().collect())
    assert got == [(1, None), (2, "high")]


def test_failing_table_does_not_stop_others(spark):
    root, cfg, topic = setup(spark)
    write_records(records(spark, [("1", event("c", 1, order(1)))]), topic)
    broken = TableSpec("broken", ("a",))
    write_records(records(spark, [("x", event("c", 1, {"a": 1}, table="broken"))], "broken"), f"{root}/src/cdc.shop.broken")
    # a file where the table's folder should be
    from keyfold.operators import layout
    layout.make_dirs(spark, cfg.lake_root)
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(f"{cfg.lake_root}/broken/log/_commit=0/x.parquet")
    fs, path = layout._fs(spark, f"{cfg.lake_root}/broken/commits")
    fs.create(path).close()
    queries, failures = run_streams(spark, cfg, [ORDERS, broken], once=True, timeout_seconds=120)
    assert set(failures) == {"broken"}
    assert not any(q.isActive for q in queries.values())
    assert state(spark, cfg) == [(1, "new", False)]


def test_bad_batches_dont_stop_a_stream(spark):
    """Tombstones only, NULL keys only, no key column, keys that don't fit: all become dead letters."""
    root, cfg, topic = setup(spark)
    batches = [
        [("1", event("c", 1, order(1)))],
        [("1", None), ("2", "")],
        [("3", event("c", 3, {"order_id": None, "status": "x"}))],
        [("4", event("c", 4, {"status": "x"}))],
        [("A", event("c", 5, order("A1"))), ("B", event("c", 6, order("B2"))), ("5", event("c", 7, {**order(5), "order_id": 5.5})),
         ("6", event("c", 8, order("6")))],
        [("1", event("u", 9, order(1, "paid")))],
    ]
    for batch in batches:
        write_records(records(spark, batch), topic)
        got = drain(spark, cfg)
    assert state(spark, cfg) == [(1, "paid", False), (6, "new", False)]
    reasons = spark.read.parquet(f"{cfg.lake_root}/orders/dead_letters").groupBy("_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"tombstone": 2, "null_key": 2, "bad_key": 3}
    assert got.dropped == 3  # batches without any usable record leave no commit


def test_pinned_schema_and_batch_without_rows(spark):
    pinned = ORDERS.with_(schema=flatten_changes(parse_envelope(records(spark, [("1", event("c", 1, order(1)))])), ORDERS)
                          .drop("_op", "_lsn", "_source_ts_ms", "_event_ts_ms", "_is_snapshot", "_deleted", "_ingested_at").schema)
    t = ChangeTable(spark, scratch_dir(spark, "pinned") + "/orders", pinned)
    process_batch(spark, records(spark, [("1", event("c", 1, order(1)))]), t, query_id="q", batch_id=0)
    process_batch(spark, records(spark, [("1", None)]), t, query_id="q", batch_id=1)
    assert [c.kind for c in t._meta()] == ["merge", "empty"]
    assert t.read().count() == 1
    t.optimize()
    assert t.read().count() == 1


def test_unknown_start_is_refused(spark):
    root, cfg, _ = setup(spark)
    cfg.starting_offsets = "middle"
    queries, failures = run_streams(spark, cfg, [ORDERS], once=True)
    assert not queries and "earliest" in failures["orders"]


def test_start_at_the_end_of_a_folder(spark):
    root, cfg, topic = setup(spark)
    cfg.starting_offsets = "latest"
    write_records(records(spark, [("1", event("c", 1, order(1)))]), topic)
    drain(spark, cfg)
    assert not ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS).exists()
    write_records(records(spark, [("2", event("c", 2, order(2)))]), topic)
    drain(spark, cfg)
    write_records(records(spark, [("3", event("c", 3, order(3)))]), topic)
    drain(spark, cfg)  # later starts go on where the checkpoint is
    assert state(spark, cfg) == [(2, "new", False), (3, "new", False)]


def test_latest_on_an_empty_topic_skips_nothing_later(spark):
    root, cfg, topic = setup(spark)
    cfg.starting_offsets = "latest"
    drain(spark, cfg)
    write_records(records(spark, [("1", event("c", 1, order(1)))]), topic)
    drain(spark, cfg)
    assert state(spark, cfg) == [(1, "new", False)]


def test_slices_of_a_batch(spark):
    root, cfg, topic = setup(spark)
    cfg.max_records_per_commit = 4
    for part in range(3):
        write_records(records(spark, [(str(k), event("c", k + 1, order(k))) for k in range(part * 7, part * 7 + 7)]).coalesce(1), topic)
    h = drain(spark, cfg)
    table = ChangeTable(spark, f"{cfg.lake_root}/orders", ORDERS)
    assert [c.events for c in table._meta()] == [4, 4, 4, 4, 4, 1] and h.events == 21
    assert len(state(spark, cfg)) == 21
    # a retried batch: the slices that were committed are the same ones again, and skipped
    batch = spark.read.schema(KAFKA_SHAPE).parquet(topic).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    keys = [[sorted(r.key for r in s.collect()) for s in slices(batch.repartition(n), 4)] for n in (1, 5)]
    assert keys[0] == keys[1] and [len(k) for k in keys[0]] == [4, 4, 4, 4, 4, 1]
    assert len(slices(batch, None)) == len(slices(batch, 100)) == 1


def sliced_batch(spark, root, pairs):
    path = f"{root}/batch"
    write_records(records(spark, pairs).coalesce(1), path)
    return spark.read.schema(KAFKA_SHAPE).parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def test_slices_together_are_slices_one_after_the_other(spark):
    """Commits, their columns and counts, dead letters and state: with junk first, a new column, a drifted type, bad keys and a slice of junk."""
    pairs = [("0", "{bad"), ("0", None)] + [(str(k), event("c", k + 1, order(k))) for k in range(5)] + [("2", event("d", 90, order(2)))]
    pairs += [(str(k), event("u", 100 + k, order(k, "moved") | {"priority": "high"})) for k in range(4)] + [("x", "{bad")] * 2
    pairs += [(str(k), event("u", 200 + k, order(k) | {"total_amount": "n/a"})) for k in range(3)] + [("X", event("c", 300, order("X1")))]
    pairs += [(str(k), event("u", 400, order(1, f"s{k}"))) for k in range(4)] + [("9", event("d", 500, order(9)))]
    root = scratch_dir(spark, "together")
    batch = sliced_batch(spark, root, pairs)
    made = []
    for way in ("one", "all"):
        t = ChangeTable(spark, f"{root}/{way}/orders", ORDERS)
        for _ in range(2):  # the second time all are there
            if way == "all":
                process_slices(spark, *numbered(batch, 2), t, query_id="q", batch_id=3)
            else:
                for i, part in enumerate(slices(batch, 2)):
                    process_batch(spark, part, t, query_id=f"q#{i}" if i else "q", batch_id=3)
        commits = [(c.commit, c.kind, c.query_id, c.batch_id, c.events, c.deduped, c.dropped, c.key_bytes, c.schema, c.batch_columns, bool(c.lag_sketch)) for c in t._meta()]
        dead = sorted(map(str, spark.read.parquet(f"{t.path}/dead_letters").collect()))
        made.append((commits, dead, sorted(map(str, t.read().drop("_ingested_at").collect()))))
    assert len(made[0][0]) > 8 and any("bad_key" in d for d in made[0][1])
    assert made[0] == made[1]


def test_large_micro_batch_is_held_in_parts(spark, monkeypatch):
    """What is parsed at once stays within PART_RECORDS, from the files of those slices; commits, dead letters and state are the same."""
    root = scratch_dir(spark, "parts")
    junk = [(str(k), "{bad") for k in range(13)]  # the first parts make no schema
    made = junk + [(str(k), event("c", k + 1, order(k))) for k in range(20)] + [(str(k), event("u", 100 + k, order(k) | {"priority": "high"})) for k in range(9)]
    for i in range(0, len(made), 7):
        write_records(records(spark, made[i:i + 7]).coalesce(1), f"{root}/batch")
    batch = spark.read.schema(KAFKA_SHAPE).parquet(f"{root}/batch").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    parse, seen, found = sink.parse_with_reasons, [], []
    monkeypatch.setattr(sink, "parse_with_reasons", lambda df, **k: (seen.append(df.count()), parse(df, **k))[1])
    for at_once in (1000, 6):
        monkeypatch.setattr(sink, "PART_RECORDS", at_once, raising=False)
        seen.clear()
        t = ChangeTable(spark, f"{root}/{at_once}/orders", ORDERS)
        for _ in range(2):  # the second time all are there
            process_slices(spark, *numbered(batch, 2), t, most=2, query_id="q", batch_id=3)
        commits = [(c.commit, c.kind, c.query_id, c.events, c.deduped, c.dropped, c.schema, c.batch_columns) for c in t._meta()]
        dead = sorted(map(str, spark.read.parquet(f"{t.path}/dead_letters").collect()))
        found.append((commits, dead, sorted(map(str, t.read().drop("_ingested_at").collect()))))
    assert 0 < max(seen) <= 6
    assert found[0] == found[1] and len(found[0][2]) == 20 and len(found[0][1]) == 13


def test_slices_of_a_stream_read_their_files(spark, monkeypatch):
    """A part of a micro-batch scans its own files, also under a folder with signs that paths escape."""
    root = scratch_dir(spark, "odd %20 b")
    cfg = StreamConfig(lake_root=f"{scratch_dir(spark, 'odd-lake')}/lake", checkpoint_root=scratch_dir(spark, "odd-ck"), source_root=root, max_records_per_commit=2)
    for part in range(4):
        write_records(records(spark, [(str(k), event("c", k + 1, order(k))) for k in range(part * 3, part * 3 + 3)]).coalesce(1), f"{root}/cdc.shop.orders")
    parse, scans = sink.parse_with_reasons, []

    def kept(df, **k):
        plan = df._jdf.queryExecution().executedPlan()
        scans.append((df.count(), "FileScan parquet" in plan.toString() and "PartitionFilters" in plan.toString()))
        return parse(df, **k)

    monkeypatch.setattr(sink, "parse_with_reasons", kept)
    monkeypatch.setattr(sink, "PART_RECORDS", 4)
    start_table_stream(spark, cfg, ORDERS, once=True).awaitTermination()
    assert max(n for n, _ in scans) <= 4 and all(scanned for _, scanned in scans)
    assert [c.events for c in cfg.table(spark, ORDERS)._meta()] == [2] * 6 and cfg.table(spark, ORDERS).read().count() == 12


def test_jobs_do_not_grow_with_the_slices(spark):
    sc, jobs = spark.sparkContext, []
    for n in (10, 60):
        root = scratch_dir(spark, "jobs")
        batch = sliced_batch(spark, root, [(str(k), event("c", k + 1, order(k))) for k in range(n)])
        t = ChangeTable(spark, f"{root}/orders", ORDERS)
        sc.setJobGroup(f"slices-{n}", "")
        process_slices(spark, *numbered(batch, 2), t, query_id="q", batch_id=0)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"slices-{n}")))
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(t._meta()) == n // 2 and t.read().count() == n
    assert jobs[1] <= jobs[0] + 6


def test_continuous_latest_per_key_and_window_counts(spark):
    root = scratch_dir(spark, "cont")
    src = f"{root}/src"
    recs = [(str(u), event("c", i, {"user_id": u, "v": i}, at=3_600_000 * (i % 3)))
            for i, u in enumerate([1, 2, 1, 3, 1, 2], start=1)]
    for chunk in (recs[:3], recs[3:]):
        write_records(records(spark, chunk, "users"), src)
    spec = TableSpec("users", ("user_id",))
    pinned = spec.with_(schema=flatten_changes(parse_envelope(spark.read.parquet(src)), spec)
                        .select("user_id", "v").schema)
    stream = spark.readStream.schema(KAFKA_SHAPE).option("maxFilesPerTrigger", 1).parquet(src)
    changes = flatten_changes(parse_envelope(stream), pinned)
    q = continuous.start_view(continuous.latest_per_key_view(changes, pinned), f"{root}/latest", f"{root}/ck1")
    q.awaitTermination()
    latest = continuous.read_latest_rows(spark, f"{root}/latest", ["user_id"])
    assert sorted((r["user_id"], r["v"]) for r in latest.collect()) == [(1, 5), (2, 6), (3, 4)]
    w = continuous.windowed_op_counts_view(changes, window="1 hour", watermark="1000 days")
    q = continuous.start_view(w, f"{root}/win", f"{root}/ck2")
    q.awaitTermination()
    counts = continuous.read_latest_rows(spark, f"{root}/win", ["window_start_ms", "_op"])
    got = sorted((r["window_start_ms"], r["events"]) for r in counts.collect())
    assert got == [(0, 2), (3_600_000, 2), (7_200_000, 2)]


def test_progress_listener_and_frame(spark):
    root, cfg, topic = setup(spark)
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        write_records(records(spark, [("1", event("c", 1, order(1)))]), topic)
        h = drain(spark, cfg)
        import time
        for _ in range(50):  # listener events arrive asynchronously
            if recorder.rows:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(recorder)
    assert recorder.frame(spark).filter("query_name = 'keyfold-orders' and input_rows = 1").count() == 1


def test_dropped_records_land_in_dead_letters(spark):
    root, cfg, topic = setup(spark)
    write_records(records(spark, [("1", event("c", 1, order(1))), ("1", None), ("2", "{bad"),
                                  ("3", event("t", 3)),
                                  ("4", event("c", 4, {"status": "x", "order_id": None}))]), topic)
    h = drain(spark, cfg)
    assert h.events == 1 and h.dropped == 4
    dlq = spark.read.parquet(f"{cfg.lake_root}/orders/dead_letters")
    assert sorted(r["_reason"] for r in dlq.collect()) == ["malformed", "null_key", "tombstone", "truncate"]
    assert state(spark, cfg) == [(1, "new", False)]


def test_retried_batch_does_not_duplicate_dead_letters_or_rows(spark):
    t = ChangeTable(spark, scratch_dir(spark, "retry") + "/orders", ORDERS)
    batch = records(spark, [("1", event("c", 1, order(1))), ("2", "{bad"), ("3", None)])
    first = process_batch(spark, batch, t, query_id="q", batch_id=7)
    again = process_batch(spark, batch, t, query_id="q", batch_id=7)
    assert first["dropped"] == 2 and again["skipped"]
    assert spark.read.parquet(f"{t.path}/dead_letters").count() == 2
    assert t.read().count() == 1 and t.commits().count() == 1


def test_windowed_counts_write_and_read_many_files(spark, monkeypatch):
    """Each stretch of time is written by as many tasks as its source has, and drained on its own."""
    from keyfold.plans import catalog

    parts, drains, write, start = [], [], catalog.write_records, catalog.continuous.start_view
    monkeypatch.setattr(catalog, "stage_records", lambda s, records, label: records.repartition(5).localCheckpoint())
    monkeypatch.setattr(catalog, "write_records", lambda df, path: (parts.append(df.rdd.getNumPartitions()), write(df, path)))
    monkeypatch.setattr(catalog.continuous, "start_view", lambda *a, **k: (drains.append(1), start(*a, **k))[1])
    assert catalog.q_windowed_op_counts(spark, "/root/testdata/sf0.001").count() > 0
    assert parts == [5] * 4 and len(drains) == 4
