"""A change-data-capture table on plain Parquet: change log + snapshots + commits.

    <path>/log/_commit=N/...        collapsed batch N (payload + metadata + _seen, _h, _cols)
    <path>/run/_commit=N/...        several log commits merged into one (levelled compaction)
    <path>/snapshot/_commit=N/...   folded state as of commit N (compacted, clustered, tombstones kept)
    <path>/_zones/..., _keys/...    per file of a snapshot: zone map and z-bounds, Bloom filter of keys
    <path>/commits/...              one row per commit: what it was and where it came from

Writing a batch is O(batch): collapse it per key, append one `_commit=N`
directory, then append the commit row. Reading folds the newest snapshot with
the log commits after it (merge on read); compaction folds the log into a new
snapshot so reads stay O(table). Only commits listed in `commits` are visible,
so a half-written batch is invisible; re-running the same (query_id, batch_id)
is skipped, and a batch whose data landed but whose commit row did not is
rewritten into the same directory (dynamic partition overwrite).

Single writer per table, as in the source design. This is a directory
convention over DataFrameWriter, not a storage engine.
"""

from __future__ import annotations

import functools
import hashlib
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.predicates import COLS, HASH, SEEN, change_order
from keyfold.functions.schema import conform, evolve
from keyfold.operators import compaction, layout, skipping
from keyfold.operators.dedupe import deduplicate_with_seen
from keyfold.operators.merge import fold_into, latest_state, partial_columns, visible
from keyfold.operators.skipping import Box
from keyfold.spec import TableSpec

COMMITS_SCHEMA = T.StructType(
    [
        T.StructField("_commit", T.LongType()),
        T.StructField("kind", T.StringType()),  # merge | empty | run | optimize | vacuum
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("deduped", T.LongType()),
        T.StructField("schema_json", T.StringType()),  # table schema after this commit
        T.StructField("batch_columns", T.StringType()),  # payload columns of this batch (json list)
        T.StructField("files", T.LongType()),
        T.StructField("key_bytes", T.LongType()),  # bytes of this commit's collapsed keys
        T.StructField("dropped", T.LongType()),  # unusable records of this batch
        T.StructField("upto", T.LongType()),  # optimize: the last log commit that the snapshot holds
        T.StructField("lo", T.LongType()),  # run: the first and the last log commit that it holds
        T.StructField("hi", T.LongType()),
        T.StructField("level", T.LongType()),  # run: how often its rows have been merged
        T.StructField("lag_sketch", T.StringType()),  # merge: KLL sketch of its changes' delivery lags (base64)
        T.StructField("ts_ms", T.LongType()),
    ]
)


#: Size of a commit's lag sketch: some 7 KB, ranks within 0.35 %.
LAG_SKETCH_K = 800
#: Prefix of directory columns.
_DIR = "_in_"


class VersionNotAvailable(ValueError):
    pass


@dataclass
class CommitInfo:
    commit: int
    kind: str
    query_id: str | None
    batch_id: int | None
    events: int | None
    deduped: int | None
    schema: T.StructType | None
    batch_columns: list[str]
    ts_ms: int
    files: int | None = None
    key_bytes: int | None = None
    dropped: int | None = None
    upto: int | None = None
    lo: int | None = None
    hi: int | None = None
    level: int | None = None
    lag_sketch: str | None = None

    @property
    def first(self) -> int:
        """The first log commit that a piece of the log holds, and the last one."""
        return self.commit if self.lo is None else self.lo

    @property
    def last(self) -> int:
        return self.commit if self.hi is None else self.hi

    @property
    def folded(self) -> int:
        """The last log commit that a snapshot holds."""
        return self.commit if self.upto is None else self.upto


@functools.lru_cache(maxsize=1024)
def _schema_of(text: str) -> T.StructType:
    """Commits of one schema share it."""
    return T.StructType.fromJson(json.loads(text))


def _info(r: dict) -> CommitInfo:
    return CommitInfo(
        commit=r["_commit"],
        kind=r["kind"],
        query_id=r.get("query_id"),
        batch_id=r.get("batch_id"),
        events=r.get("events"),
        deduped=r.get("deduped"),
        schema=_schema_of(r["schema_json"]) if r.get("schema_json") else None,
        batch_columns=json.loads(r["batch_columns"]) if r.get("batch_columns") else [],
        ts_ms=r.get("ts_ms") or 0,
        files=r.get("files"),
        key_bytes=r.get("key_bytes"),
        dropped=r.get("dropped"),
        upto=r.get("upto"),
        lo=r.get("lo"),
        hi=r.get("hi"),
        level=r.get("level"),
        lag_sketch=r.get("lag_sketch"),
    )


def getattr_row(c: CommitInfo, name: str):
    """A commit as a commits-table row field."""
    if name == "_commit":
        return c.commit
    if name == "schema_json":
        return c.schema.json() if c.schema is not None else None
    if name == "batch_columns":
        return json.dumps(c.batch_columns) if c.batch_columns else None
    return getattr(c, name)


class ChangeTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.log_path = f"{self.path}/log"
        self.run_path = f"{self.path}/run"
        self.snapshot_path = f"{self.path}/snapshot"
        self.zones_path = f"{self.path}/_zones"  # hidden from listings of data files
        self.keys_path = f"{self.path}/_keys"
        self.commits_path = f"{self.path}/commits"
        self._read_files: dict[tuple[str, int], list[dict]] = {}
        self._meta_key: tuple | None = None
        self._meta_cache: list[CommitInfo] = []

    # ------------------------------------------------------------ metadata

    def exists(self) -> bool:
        return layout.path_exists(self.spark, self.commits_path)

    def commits(self) -> DataFrame:
        """The commit rows (history, summaries), read by Spark from their files."""
        rows = self.spark.read.schema(COMMITS_SCHEMA).json(self.commits_path)
        return rows.dropDuplicates(["_commit", "kind"])  # consolidation may briefly leave a row twice

    # Commit rows are small JSON files written and read through the Hadoop
    # FileSystem API on the driver, like a table format's log: metadata work
    # costs no Spark job. Each file is written under a hidden name and renamed,
    # so readers never see a partial row.

    def _commit_listing(self) -> tuple:
        """Names and sizes of the visible commit files (cheap listing)."""
        fs, jpath = layout._fs(self.spark, self.commits_path)
        if not fs.exists(jpath):
            return ()
        return tuple(sorted((st.getPath().getName(), st.getLen()) for st in fs.listStatus(jpath)
                            if st.getPath().getName().endswith(".json")))

    def _read_commit_file(self, name: str) -> list[dict]:
        fs, _ = layout._fs(self.spark, self.commits_path)
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.commits_path}/{name}"))
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [json.loads(line) for line in text.splitlines() if line.strip()]

    def _write_commit_file(self, rows: list[dict]) -> str:
        fs, _ = layout._fs(self.spark, self.commits_path)
        jvm = self.spark.sparkContext._jvm
        first = rows[0]["_commit"]
        name = f"{first:020d}-{uuid.uuid4().hex[:12]}.json"
        tmp = jvm.org.apache.hadoop.fs.Path(f"{self.commits_path}/.{name}.tmp")
        final = jvm.org.apache.hadoop.fs.Path(f"{self.commits_path}/{name}")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(tmp, final):
            raise OSError(f"could not publish commit file {final}")
        return name

    def _meta(self) -> list[CommitInfo]:
        """The commit list (one small row per commit) on the driver.

        Re-read only when the commit folder's listing changed; a writer's own
        commits do not trigger a re-read.
        """
        key = self._commit_listing()
        if key == self._meta_key:
            return list(self._meta_cache)
        # Consolidation may briefly leave a row twice (same content). Maintenance and
        # the stream may end on the same number: those are two commits.
        by_commit: dict[tuple[int, str], dict] = {}
        # a commit file never changes: only names that are new are opened
        self._read_files = {file: self._read_files.get(file) or self._read_commit_file(file[0]) for file in key}
        for file in key:
            for r in self._read_files[file]:
                by_commit.setdefault((r["_commit"], r["kind"]), r)
        out = [_info(by_commit[c]) for c in sorted(by_commit)]
        self._meta_key, self._meta_cache = key, out
        return list(out)

    def _write_commit(self, info: dict) -> None:
        cached = self._meta_key is not None and self._meta_key == self._commit_listing()
        row = {f.name: info.get(f.name) for f in COMMITS_SCHEMA.fields}
        self._write_commit_file([row])
        if cached:
            # Extend the cached list with our own row instead of re-reading.
            self._meta_cache.append(_info(row))
            self._meta_key = self._commit_listing()
        else:
            self._meta_key = None

    def version(self) -> int | None:
        meta = self._meta()
        return meta[-1].commit if meta else None

    def schema(self) -> T.StructType | None:
        for c in reversed(self._meta()):
            if c.schema is not None:
                return c.schema
        return None

    # --------------------------------------------------------------- write

    def append_changes(
        self,
        changes: DataFrame,
        *,
        query_id: str | None = None,
        batch_id: int | None = None,
        events: int | None = None,
        dropped: int | None = None,
    ) -> dict:
        """Collapse a flattened batch per key and commit it. Returns a summary.

        Rows without a key, or whose key doesn't fit its stored type, can't be
        applied and are left out (a stream has put them to its dead letters
        before). A batch without any row is recorded, but has no directory.
        """
        meta = self._meta()
        if query_id is not None and batch_id is not None:
            for c in meta:
                if c.query_id == query_id and c.batch_id == batch_id:
                    return {"table": self.spec.name, "commit": c.commit, "skipped": True,
                            "events": c.events, "deduped": c.deduped}
        n = (meta[-1].commit + 1) if meta else 0
        if "_ingested_at" not in changes.columns:
            changes = changes.withColumn("_ingested_at", F.current_timestamp())
        payload = [c for c in changes.columns if not c.startswith("_")]
        batch_schema = T.StructType([changes.schema[c] for c in payload])
        prior = next((c.schema for c in reversed(meta) if c.schema is not None), None)
        table_schema = evolve(prior, batch_schema, keys=self.spec.primary_key)
        changes = conform(changes, table_schema)
        for k in self.spec.primary_key:
            changes = changes.filter(F.col(f"`{k}`").isNotNull())

        tag = uuid.uuid4().hex[:8]
        counted = Observation(f"events_{n}_{tag}")
        written = Observation(f"deduped_{n}_{tag}")
        lag = F.unix_millis("_ingested_at") - F.col("_event_ts_ms")
        collapsed = deduplicate_with_seen(changes.observe(
            counted, F.count(F.lit(1)).alias("events"), F.base64(F.kll_sketch_agg_bigint(lag, LAG_SKETCH_K)).alias("lags")), self.spec)
        collapsed = collapsed.withColumn(COLS, F.array(*[F.lit(c) for c in payload]).cast("array<string>"))
        out = self.log_path
        # One job: collapse, write `_commit=N`, and count input and output rows
        # on the way (observed metrics, no second pass).
        (
            collapsed.withColumn("_commit", F.lit(n).cast("long"))
            .observe(written, F.count(F.lit(1)).alias("rows"), _key_bytes(self.spec, collapsed).alias("key_bytes"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_commit")
            .parquet(out)
        )
        seen_events = counted.get.get("events", 0)
        deduped = written.get.get("rows", 0)
        key_bytes = written.get.get("key_bytes", 0)
        self._write_commit(
            {
                "_commit": n,
                "kind": "merge" if deduped else "empty",
                "query_id": query_id,
                "batch_id": batch_id,
                "events": events if events is not None else seen_events,
                "deduped": deduped,
                "schema_json": (table_schema if deduped else prior).json() if deduped or prior else None,
                "batch_columns": json.dumps(payload),
                "files": None,
                "key_bytes": key_bytes,
                "dropped": dropped,
                "lag_sketch": counted.get.get("lags") if seen_events else None,
                "ts_ms": int(time.time() * 1000),
            }
        )
        return {"table": self.spec.name, "commit": n, "skipped": False,
                "events": seen_events, "deduped": deduped, "collapsed": seen_events - deduped}

    def append_slices(self, changes: DataFrame, slices: Sequence[tuple[int, str, int]], *, batch_id: int) -> list[int]:
        """Commit many small flattened batches of one schema by one job, a commit each, as `append_changes` would one after the other.

        `changes` carries the number of each row's slice in `_slice`; `slices` are
        (number, query id, unusable records) in order. Those that are committed already are
        skipped. Their rows in the commits table come in one file, once all data is there.
        """
        meta = self._meta()
        done = {(c.query_id, c.batch_id) for c in meta}
        slices = [s for s in slices if (s[1], batch_id) not in done]
        if not slices:
            return []
        n = (meta[-1].commit + 1) if meta else 0
        payload = [c for c in changes.columns if not c.startswith("_")]
        prior = next((c.schema for c in reversed(meta) if c.schema is not None), None)
        table_schema = evolve(prior, T.StructType([changes.schema[c] for c in payload]), keys=self.spec.primary_key)
        numbers = self.spark.createDataFrame([(s, n + i) for i, (s, _, _) in enumerate(slices)], "_slice long, _commit long")
        changes = conform(changes.join(F.broadcast(numbers), "_slice").drop("_slice"), table_schema)
        changes = changes.withColumn("_ingested_at", F.timestamp_millis(F.lit(int(time.time() * 1000))))  # one time for all jobs
        for k in self.spec.primary_key:
            changes = changes.filter(F.col(f"`{k}`").isNotNull())
        if len(slices) >= 2 * self.spark.sparkContext.defaultParallelism:
            changes = changes.repartition("_commit")  # a file per commit; each is small, the collapse needs no other exchange
        collapsed = deduplicate_with_seen(changes, self.spec.with_(primary_key=("_commit", *self.spec.primary_key)))
        collapsed = collapsed.withColumn(COLS, F.array(*[F.lit(c) for c in payload]).cast("array<string>"))
        collapsed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_commit").parquet(self.log_path)

        lag = F.unix_millis("_ingested_at") - F.col("_event_ts_ms")
        came = {r["_commit"]: r for r in changes.groupBy("_commit").agg(
            F.count(F.lit(1)).alias("events"), F.base64(F.kll_sketch_agg_bigint(lag, LAG_SKETCH_K)).alias("lags")).collect()}
        paths = [p for p in (f"{self.log_path}/_commit={c}" for c in came) if layout.path_exists(self.spark, p)]
        kept: dict[int, tuple] = {}
        if paths:
            keys = T.StructType([T.StructField(k, table_schema[k].dataType) for k in self.spec.primary_key])
            stored = self.spark.read.schema(keys).option("basePath", self.log_path).parquet(*paths)
            kept = {r["_commit"]: (r["rows"], r["key_bytes"]) for r in stored.groupBy(F.col("_commit").cast("long").alias("_commit")).agg(
                F.count(F.lit(1)).alias("rows"), _key_bytes(self.spec, stored).alias("key_bytes")).collect()}
        rows, known = [], prior
        for i, (_, query_id, dropped) in enumerate(slices):
            deduped, key_bytes = kept.get(n + i, (0, 0))
            held = came.get(n + i)
            known = table_schema if deduped else known
            info = {"_commit": n + i, "kind": "merge" if deduped else "empty", "query_id": query_id, "batch_id": batch_id,
                    "events": held["events"] if held else 0, "deduped": deduped, "schema_json": known.json() if known else None,
                    "batch_columns": json.dumps(payload), "key_bytes": key_bytes, "dropped": dropped,
                    "lag_sketch": held["lags"] if held else None, "ts_ms": int(time.time() * 1000)}
            rows.append({f.name: info.get(f.name) for f in COMMITS_SCHEMA.fields})
        self._write_commit_file(rows)
        self._meta_key = None
        return [n + i for i in range(len(slices))]

    # ---------------------------------------------------------------- read

    def _plan(self, as_of: int | None):
        meta = self._meta()
        if not meta:
            return None, [], None
        latest = meta[-1].commit
        n = latest if as_of is None else as_of
        if n > latest or n < 0:
            raise VersionNotAvailable(f"{self.spec.name}: version {n} does not exist (latest {latest})")
        vacuumed_below = max((c.batch_id or 0 for c in meta if c.kind == "vacuum" and c.commit <= latest),
                             default=-1)
        snaps = [c for c in meta if c.kind == "optimize" and c.commit <= n]
        snap, folded = (snaps[-1].commit, snaps[-1].folded) if snaps else (None, None)
        if n < vacuumed_below:
            raise VersionNotAvailable(
                f"{self.spec.name}: version {n} was vacuumed (oldest readable {vacuumed_below})"
            )
        # commits that a stream made while the snapshot was being written come after it
        pieces = [c for c in meta if c.kind in ("merge", "run") and c.commit <= n and (folded is None or c.first > folded)]
        runs = [c for c in pieces if c.kind == "run"]
        inside = lambda c, r: r is not c and r.first <= c.first and c.last <= r.last and (c.kind == "merge" or r.commit > c.commit)
        pieces = [c for c in pieces if not any(inside(c, r) for r in runs)]
        schema = next((c.schema for c in reversed(meta) if c.commit <= n and c.schema is not None), None)
        return snap, sorted(pieces, key=lambda c: c.first), schema

    def _dir(self, piece: CommitInfo) -> str:
        root = {"merge": self.log_path, "run": self.run_path, "optimize": self.snapshot_path}[piece.kind]
        return f"{root}/_commit={piece.commit}"

    # Reads fold only the keys the log touched when their number is known to
    # be small: the commits table records each commit's collapsed row count,
    # a hard upper bound on its distinct keys.
    BROADCAST_KEYS_MAX_ROWS = 1_000_000
    BROADCAST_KEYS_MAX_BYTES = 64 * 1024 * 1024

    def _meta_fields(self) -> list:
        return [
            T.StructField("_op", T.StringType()),
            T.StructField("_lsn", T.LongType()),
            T.StructField("_source_ts_ms", T.LongType()),
            T.StructField("_event_ts_ms", T.LongType()),
            T.StructField("_is_snapshot", T.BooleanType()),
            T.StructField("_deleted", T.BooleanType()),
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField(HASH, T.LongType()),
            T.StructField(SEEN, T.BooleanType()),
        ]

    def _inputs(self, as_of: int | None = None):
        """(snapshot frame or None, log frame or None, schema, (key rows, key bytes))
        where the bounds cover every key the log commits touch."""
        snap, pieces, schema = self._plan(as_of)
        if schema is None:
            return None, None, None, (0, 0)
        log = self._read_pieces(pieces, schema) if pieces else None
        sdf = self._read_snapshot(snap, schema) if snap is not None else None
        rows = sum((c.deduped or 0) for c in pieces)
        size = sum((c.key_bytes if c.key_bytes is not None else float("inf")) for c in pieces)
        return sdf, log, schema, (rows, size)

    def _read_pieces(self, pieces: list[CommitInfo], schema: T.StructType) -> DataFrame:
        return self._read_typed([(self._dir(c), c.schema) for c in pieces], schema,
                                [*self._meta_fields(), T.StructField(COLS, T.ArrayType(T.StringType()))])

    def _read_snapshot(self, snap: int, schema: T.StructType, files: list[str] | None = None) -> DataFrame:
        """Snapshot ``snap``, or only some of its files."""
        written = next(c.schema for c in self._meta() if c.kind == "optimize" and c.commit == snap) or schema
        if self.spec.buckets and files is None:
            rows = self._bucketed(f"{self.snapshot_path}/_commit={snap}", written)
            later = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in rows.columns}
            return conform(rows.withColumns(later), schema).select(*[f"`{f.name}`" for f in [*schema.fields, *self._meta_fields()]])
        paths = [f"{self.snapshot_path}/_commit={snap}"] if files is None else files
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *self._meta_fields()]))
        return self._read_typed([(path, written) for path in paths], schema, self._meta_fields())

    def _bucketed(self, path: str, written: T.StructType) -> DataFrame:
        """A bucketed snapshot, under a name of the session catalog: only that carries the bucketing to the planner."""
        name = _catalog_name(path)
        if not self.spark.catalog.tableExists(name):
            schema = T.StructType([*written.fields, *self._meta_fields()])
            ddl = self.spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
            keys = ", ".join(f"`{c}`" for c in self.spec.primary_key)
            place = path.replace("'", "\\'")
            self.spark.sql(f"create table {name} ({ddl}) using parquet clustered by ({keys}) into {self.spec.buckets} buckets location '{place}'")
        return self.spark.table(name)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Log rows where their buckets are."""
        return rows.repartition(self.spec.buckets, *[F.col(f"`{c}`") for c in self.spec.primary_key]) if self.spec.buckets else rows

    def _read_typed(self, dirs: list[tuple[str, T.StructType]], schema: T.StructType, more: list) -> DataFrame:
        """Directories as one frame of the table's present types.

        Files keep the types of their time; directories whose types agree are
        read together, so there is one branch per change of a type, not per commit.
        """
        now = {f.name: f.dataType for f in schema.fields}
        groups: dict[tuple[str, str], tuple[T.StructType, list[str]]] = {}
        for path, then in dirs:
            before = [f for f in then.fields if now.get(f.name) not in (None, f.dataType)]
            types = {f.name: f.dataType for f in before}
            kind = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType), True) for f in schema.fields])
            groups.setdefault((path.partition("/_commit=")[0], T.StructType(before).json()), (kind, []))[1].append(path)
        frames = [conform(self.spark.read.schema(T.StructType([*kind.fields, *more])).option("basePath", root).parquet(*paths), schema)
                  .select(*[f"`{f.name}`" for f in [*schema.fields, *more]])
                  for (root, _), (kind, paths) in groups.items()]
        return functools.reduce(DataFrame.unionByName, frames)

    def state(self, as_of: int | None = None) -> DataFrame | None:
        """Folded state with tombstones (`_seen`), as of commit `as_of`."""
        sdf, log, schema, bound = self._inputs(as_of)
        if schema is None or (sdf is None and log is None):
            return None
        if log is None:
            return sdf
        partial = self._partial(self._plan(as_of)[1], schema)
        if sdf is None:
            return latest_state(self._dealt(log), self.spec, partial_columns=partial)
        if self.spec.buckets:
            return fold_into(sdf, self._dealt(log), self.spec, partial)
        with_cols = self._with_all_columns(sdf, schema)
        rows, size = bound
        if rows > self.BROADCAST_KEYS_MAX_ROWS or size > self.BROADCAST_KEYS_MAX_BYTES:
            # Many touched keys: one grouped fold over snapshot and log.
            return latest_state(with_cols.unionByName(log), self.spec, partial_columns=partial)
        # Few touched keys (bounded above): keys broadcast, snapshot not shuffled.
        pk = list(self.spec.primary_key)
        keys = F.broadcast(log.select(*pk).distinct())
        untouched = sdf.join(keys, pk, "left_anti")
        touched = with_cols.join(keys, pk, "left_semi")
        folded = latest_state(touched.unionByName(log), self.spec, partial_columns=partial)
        return untouched.unionByName(folded.select(*untouched.columns))

    @staticmethod
    def _partial(pieces: list[CommitInfo], schema: T.StructType) -> list[str]:
        """Columns that some piece of the log lacks (snapshot rows carry every column)."""
        return partial_columns([[f.name for f in schema.fields]] + [c.batch_columns for c in pieces])

    @staticmethod
    def _with_all_columns(rows: DataFrame, schema: T.StructType) -> DataFrame:
        return rows.withColumn(COLS, F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>"))

    # ------------------------------------------------------- part of a table

    def files_for(self, *, box: Box | None = None, keys: DataFrame | None = None, as_of: int | None = None) -> DataFrame | None:
        """(file) of the snapshot that may hold rows of the box, or rows of these keys; None: they can't be told.

        ``keys``: distinct rows of the key columns, at most ``skipping.MAX_PROBED_KEYS`` of them.
        """
        snap, _, now = self._plan(as_of)
        written = f"{self.keys_path if keys is not None else self.zones_path}/_commit={snap}"
        if snap is None or not layout.path_exists(self.spark, f"{written}/_SUCCESS"):
            return None
        index = self.spark.read.parquet(written)
        if keys is not None:
            return skipping.holds_a_key(keys, self.spec.primary_key, index)
        # a column whose type has drifted since has no zones
        test = skipping.meets_box(box, [f.name for f in now.fields if f"min_{f.name}" in index.columns and index.schema[f"min_{f.name}"].dataType == f.dataType])
        if self.spec.zorder_by and layout.path_exists(self.spark, f"{self.zones_path}/bounds-{snap}"):
            held = self.spark.read.parquet(f"{self.zones_path}/bounds-{snap}").first()
            schema = next(c.schema for c in self._meta() if c.kind == "optimize" and c.commit == snap)
            if any(c in box for c in held.columns) and all(schema[c].dataType == now[c].dataType for c in held.columns):
                ranges = skipping.box_ranges(self.spark, box, schema, held.columns, [json.loads(b) for b in held.bounds], held.bits)
                test = test & skipping.meets_ranges(ranges)
        return index.where(test).select("file")

    def rows_of(self, keys: DataFrame, as_of: int | None = None, *, tombstones: bool = False) -> DataFrame:
        """The rows of these keys (distinct, a column per key column): only files whose filters pass one are opened."""
        snap, pieces, schema = self._plan(as_of)
        if schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        pk = list(self.spec.primary_key)
        keys = keys.select(*pk)
        parts = [self._read_pieces(pieces, schema).join(keys, pk, "left_semi")] if pieces else []
        if snap is not None:
            few = keys.limit(skipping.MAX_PROBED_KEYS + 1).count() <= skipping.MAX_PROBED_KEYS
            files = self.files_for(keys=keys, as_of=as_of) if few else None
            sdf = self._read_snapshot(snap, schema, None if files is None else [r.file for r in files.collect()])
            parts.append(self._with_all_columns(sdf.join(keys, pk, "left_semi"), schema))
        state = latest_state(functools.reduce(DataFrame.unionByName, parts), self.spec, partial_columns=self._partial(pieces, schema))
        return state if tombstones else visible(state, self.spec)

    def read_where(self, box: Box, as_of: int | None = None) -> DataFrame:
        """The rows in a box: ``{column: (least, largest)}``, both included, None for no limit.

        Of the snapshot only the files that the box can meet are opened, and for
        keys that the log has touched since, those that hold such a key.
        """
        snap, pieces, schema = self._plan(as_of)
        if schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        files = self.files_for(box=box, as_of=as_of) if snap is not None else None
        if files is None:
            return self.read(as_of).where(skipping.in_box(box))
        found = self._read_snapshot(snap, schema, [r.file for r in files.collect()]).where(skipping.in_box(box))
        if not pieces:
            return visible(found, self.spec)
        pk = list(self.spec.primary_key)
        keys = self._read_pieces(pieces, schema).select(*pk).distinct()
        touched = self.rows_of(keys, as_of, tombstones=True).where(skipping.in_box(box))
        bounded = sum((c.deduped or 0) for c in pieces) <= self.BROADCAST_KEYS_MAX_ROWS
        untouched = found.join(F.broadcast(keys) if bounded else keys, pk, "left_anti")
        return visible(untouched.unionByName(touched.select(*untouched.columns)), self.spec)

    def read(self, as_of: int | None = None) -> DataFrame:
        """The table as consumers see it (tombstones hidden; soft deletes kept)."""
        st = self.state(as_of)
        if st is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return visible(st, self.spec)

    def data_file_stats(self, small_file_threshold_mb: int = layout.SMALL_FILE_MB) -> DataFrame:
        """Data files on disk (log + snapshots, live or superseded), not metadata."""
        return layout.stats_of(layout.list_files(self.spark, self.log_path, self.run_path, self.snapshot_path), small_file_threshold_mb)

    def consolidate_commits(self) -> int:
        """Rewrite the commit rows into one file, then drop the old small files.

        The new file is published before any old one is deleted and readers
        deduplicate by commit number, so a crash at any point loses nothing.
        """
        listing = self._commit_listing()
        if len(listing) <= 1:
            return 0
        rows = [{f.name: getattr_row(c, f.name) for f in COMMITS_SCHEMA.fields} for c in self._meta()]
        self._write_commit_file(rows)
        fs, _ = layout._fs(self.spark, self.commits_path)
        jvm = self.spark.sparkContext._jvm
        for name, _size in listing:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.commits_path}/{name}"), False)
        self._meta_key = None
        return len(listing)

    def _active_dirs(self, as_of: int | None = None) -> list[str]:
        """Directories a read of version `as_of` opens: the snapshot and the log
        commits after it."""
        snap, pieces, _ = self._plan(as_of)
        dirs = [self._dir(c) for c in pieces]
        if snap is not None:
            dirs.append(f"{self.snapshot_path}/_commit={snap}")
        return dirs

    def active_files(self, as_of: int | None = None) -> DataFrame:
        """(path, length) of the files a read of version `as_of` opens."""
        return layout.list_files(self.spark, *self._active_dirs(as_of))

    def schema_registry(self) -> DataFrame:
        """(column_name, data_type, first_commit) for every payload column the
        table has had: the running union of batch schemas (E7)."""
        fields = F.from_json("schema_json", "struct<fields: array<struct<name: string, type: string>>>")["fields"]
        names = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}
        kind = F.col("f.type")
        for ours, sql in names.items():
            kind = F.when(F.col("f.type") == ours, sql).otherwise(kind)
        seen = self.commits().where("schema_json is not null").select("_commit", F.explode(fields).alias("f"))
        return seen.groupBy(F.col("f.name").alias("column_name")).agg(
            F.min_by(kind, "_commit").alias("data_type"), F.min("_commit").alias("first_commit"))

    def applied_rows(self, commit: int) -> int:
        """How many rows of merge commit `commit` became their key's latest
        state (Q6): `deduped` counts collapsed rows, so a pure replay reports
        rows merged; this counts the ones that changed something. Joins the
        commit's rows with the folded state as of the previous commit."""
        info = next((c for c in self._meta() if c.commit == commit and c.kind == "merge"), None)
        if info is None:
            raise VersionNotAvailable(f"{self.spec.name}: no merge commit {commit}")
        pk = list(self.spec.primary_key)
        rows = self.spark.read.parquet(f"{self.log_path}/_commit={commit}").select(
            *pk, change_order().alias("_new"))
        prior = [c.commit for c in self._meta() if c.commit < commit and c.kind != "vacuum"]
        if not prior or self._plan(prior[-1])[2] is None:
            return rows.count()
        before = self.rows_of(rows.select(*pk), prior[-1], tombstones=True)
        old = before.select(*pk, change_order().alias("_old"))
        joined = rows.join(old, pk, "left")
        return joined.filter(F.col("_old").isNull() | (F.col("_new") > F.col("_old"))).count()

    def changes_between(self, a: int, b: int) -> DataFrame:
        """Net change from version ``a`` to version ``b`` (K13): (key columns, _change, _before, _after).

        ``_change`` is insert, update or delete, as a consumer of live rows sees it;
        ``_before`` and ``_after`` are the row's images (null where there is none).
        Keys come from the log commits between the versions, images from these
        keys' rows alone: no state is read whole.
        """
        if not a <= b:
            raise ValueError("the first version must not be later than the second")
        meta = self._meta()
        schema = self._plan(b)[2]
        self._plan(a)  # both must be readable
        pk = list(self.spec.primary_key)
        wanted = [c for c in meta if c.kind == "merge" and a < c.commit <= b]
        runs = [c for c in meta if c.kind == "run"]
        parts: dict[tuple[int, str], CommitInfo] = {}
        for c in wanted:  # a commit that a vacuum has removed lives on in a run
            held = next((p for p in [c, *[r for r in runs if r.first <= c.commit <= r.last]] if layout.path_exists(self.spark, self._dir(p))), None)
            if held is None:
                raise VersionNotAvailable(f"{self.spec.name}: commit {c.commit} was vacuumed")
            parts[held.commit, held.kind] = held
        payload = [f.name for f in schema.fields]
        image = F.struct(*[F.col(f"`{c}`") for c in payload])
        if not parts:
            kind = self.spark.createDataFrame([], schema).select(*pk, F.lit("").alias("_change"), image.alias("_before"), image.alias("_after"))
            return kind
        keys = self._read_pieces(list(parts.values()), schema).select(*pk).distinct()

        def images(version: int, name: str) -> DataFrame:
            rows = self.rows_of(keys, version).where(~F.col("_deleted"))
            rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in schema.fields])
            return rows.select(*pk, image.alias(name))

        before, after = F.col("_before"), F.col("_after")
        met = images(a, "_before").join(images(b, "_after"), pk, "full_outer").where(~before.eqNullSafe(after))
        change = F.when(before.isNull(), "insert").when(after.isNull(), "delete").otherwise("update")
        return met.select(*pk, change.alias("_change"), "_before", "_after")

    def ingest_summary(self) -> DataFrame:
        """Commits, events, rows merged and events collapsed (K11), from the
        commits table."""
        merges = self.commits().filter(F.col("kind") == "merge")
        return merges.agg(
            F.lit(self.spec.name).alias("table_name"),
            F.count(F.lit(1)).alias("commits"),
            F.coalesce(F.sum("events"), F.lit(0)).cast("long").alias("events"),
            F.coalesce(F.sum("deduped"), F.lit(0)).cast("long").alias("rows_merged"),
            F.coalesce(F.sum(F.col("events") - F.col("deduped")), F.lit(0)).cast("long").alias("collapsed"),
        )

    def lag_quantiles(self, probabilities: Sequence[float] = (0.5, 0.99)) -> DataFrame:
        """(probability, lag_ms): quantiles of the time from a change to its ingestion.

        From the sketches of the commits, merged: the log isn't read. Ranks are
        right within 0.35 % (with 99 % confidence).
        """
        merged = self.commits().where("lag_sketch is not null").agg(F.kll_merge_agg_bigint(F.unbase64("lag_sketch"), LAG_SKETCH_K).alias("s"))
        asked = F.array(*[F.lit(float(p)) for p in probabilities])
        pairs = merged.where(F.kll_sketch_get_n_bigint("s") > 0).select(F.inline(F.arrays_zip(
            asked.alias("probability"), F.kll_sketch_get_quantile_bigint("s", asked).alias("lag_ms"))))
        return pairs.toDF("probability", "lag_ms")

    def history(self, limit: int = 20) -> DataFrame:
        return self.commits().orderBy(F.desc("_commit")).limit(limit)

    # ---------------------------------------------------------- maintenance

    def optimize(self, *, target_file_mb: float = 128, zorder: bool = True) -> dict:
        """Fold everything into one snapshot commit, compacted (and clustered)."""
        meta = self._meta()
        if not meta:
            raise FileNotFoundError(f"no table at {self.path}")
        # everything below refers to one version, whatever a stream commits meanwhile
        as_of = meta[-1].commit
        upto = max((c.commit for c in meta if c.kind in ("merge", "empty")), default=-1)
        st = self.state(as_of)
        if st is None:
            raise FileNotFoundError(f"no rows at {self.path}")
        written = self._plan(as_of)[2]
        sdf, log, _, _ = self._inputs(as_of)
        keep = list(self.spec.zorder_by) + list(self.spec.partition_by)
        parts = [d.select(*keep) for d in (sdf, log) if d is not None]
        raw = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        n = meta[-1].commit + 1
        before = layout.bytes_under(self.spark, self.path)
        # Sized from what the current version reads, not from superseded
        # directories a vacuum has not removed yet.
        live_bytes = sum(layout.bytes_under(self.spark, d) for d in self._active_dirs(as_of))
        n_files = layout.plan_files(live_bytes, target_file_mb)
        started = time.monotonic()
        bounds, bits = None, 0
        if zorder and self.spec.zorder_by:
            bits = layout.zorder_bits(n_files, len(self.spec.zorder_by))
            bounds = layout.zorder_bounds(raw, self.spec.zorder_by, bits)  # quantiles from the scans, not from the fold
        data = st if self.spec.buckets else layout.clustered(
            st, n_files,
            zorder_by=self.spec.zorder_by if zorder else (),
            partition_by=self.spec.partition_by,
            key=self.spec.primary_key,
            bounds=bounds, bits=bits,
        )
        writer = data.write.mode("overwrite")
        if self.spec.partition_by:
            # Directories from copies: the files keep the columns themselves, so an
            # empty string or any other value reads back as it was.
            copies = {f"{_DIR}{c}": F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in self.spec.partition_by}
            writer = data.withColumns(copies).write.mode("overwrite").partitionBy(*copies)
        path = f"{self.snapshot_path}/_commit={n}"
        if self.spec.buckets:  # the fold has dealt the rows already: a task writes its buckets
            writer.bucketBy(self.spec.buckets, *self.spec.primary_key).option("path", path).saveAsTable(_catalog_name(path))
        else:
            writer.parquet(path)
        elapsed = time.monotonic() - started
        self._index_snapshot(n, written, bounds, bits)
        self._write_commit({
            "_commit": n, "kind": "optimize", "schema_json": written.json(),
            "files": None, "upto": upto, "ts_ms": int(time.time() * 1000),
        })
        return {"table": self.spec.name, "commit": n, "bytes_before": before,
                "optimize_seconds": round(elapsed, 3), "zordered_by": list(self.spec.zorder_by) if zorder else []}

    def _index_snapshot(self, n: int, schema: T.StructType, bounds: list[list] | None, bits: int) -> None:
        """Zone map, z-bounds and Bloom filters of snapshot ``n``, beside it."""
        spec, snapshot = self.spec, self.spark.read.schema(T.StructType([*schema.fields, *self._meta_fields()])).parquet(f"{self.snapshot_path}/_commit={n}")
        orderable = [c for c in dict.fromkeys([*spec.zorder_by, *spec.primary_key, *spec.partition_by])
                     if isinstance(schema[c].dataType, T.AtomicType)]
        if bounds is not None:
            held = self.spark.createDataFrame([(list(spec.zorder_by), [json.dumps(b) for b in bounds], bits)],
                                              "columns array<string>, bounds array<string>, bits int")
            held.coalesce(1).write.mode("overwrite").parquet(f"{self.zones_path}/bounds-{n}")
        zones = skipping.zone_map(snapshot, orderable, zorder_by=spec.zorder_by, bounds=bounds, bits=bits)
        zones.write.mode("overwrite").parquet(f"{self.zones_path}/_commit={n}")
        size = self.spark.read.parquet(f"{self.zones_path}/_commit={n}").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
        filters = skipping.bloom_filters(snapshot, spec.primary_key, skipping.bloom_bits(size.rows or 0, size.files))
        filters.write.mode("overwrite").parquet(f"{self.keys_path}/_commit={n}")

    def compact(self, *, fanout: int = 4, target_file_mb: float = 128, largest_mb: float = 4096) -> list[dict]:
        """Merge small neighbours of the log into runs, level by level (C3); the snapshot isn't touched.

        Returns a row per run: its level, the log commits that it holds, and the
        bytes read and written for it.
        """
        done: list[dict] = []
        while True:
            _, pieces, schema = self._plan(None)
            known = {(c.first, c.last): c for c in pieces}
            plan = compaction.plan_merges(
                [compaction.Piece(c.first, c.last, c.level or 0, layout.bytes_under(self.spark, self._dir(c)), frozenset(c.batch_columns)) for c in pieces],
                fanout=fanout, largest=int(largest_mb * 1024 * 1024))
            if not plan:
                return done
            done += [self._merge_run([known[p.lo, p.hi] for p in group], sum(p.size for p in group), schema, target_file_mb) for group in plan]

    def _merge_run(self, pieces: list[CommitInfo], size: int, schema: T.StructType, target_file_mb: float) -> dict:
        """One run from pieces with the same columns: the latest change per key, whether it was ever more than a delete, and no column mixed."""
        n = self._meta()[-1].commit + 1
        rows = latest_state(self._read_pieces(pieces, schema), self.spec, partial_columns=[])
        rows = rows.withColumn(COLS, F.array(*[F.lit(c) for c in pieces[0].batch_columns]).cast("array<string>"))
        written = Observation(f"run_{n}_{uuid.uuid4().hex[:8]}")
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in self.spec.primary_key])  # whole files from however many there were
        (rows.observe(written, F.count(F.lit(1)).alias("rows"), _key_bytes(self.spec, rows).alias("key_bytes"))
         .repartitionByRange(layout.plan_files(size, target_file_mb), spread)
         .write.mode("overwrite").parquet(f"{self.run_path}/_commit={n}"))
        level = max(c.level or 0 for c in pieces) + 1
        self._write_commit({
            "_commit": n, "kind": "run", "lo": pieces[0].first, "hi": pieces[-1].last, "level": level, "deduped": written.get.get("rows", 0),
            "key_bytes": written.get.get("key_bytes", 0) or 0, "schema_json": schema.json(), "batch_columns": json.dumps(pieces[0].batch_columns),
            "ts_ms": int(time.time() * 1000)})
        return {"table": self.spec.name, "commit": n, "level": level, "pieces": len(pieces), "lo": pieces[0].first, "hi": pieces[-1].last,
                "bytes_read": size, "bytes_written": layout.bytes_under(self.spark, f"{self.run_path}/_commit={n}")}

    def vacuum(self, *, retain_hours: float = 168, allow_short_retention: bool = False,
               now_ms: int | None = None) -> dict:
        """Delete log and snapshot directories superseded by a newer snapshot
        and older than the retention window. Bounds time travel."""
        if retain_hours < 168 and not allow_short_retention:
            raise ValueError("retention below 168 hours needs allow_short_retention=True")
        meta = self._meta()
        now_ms = now_ms if now_ms is not None else int(time.time() * 1000)
        horizon = now_ms - retain_hours * 3600 * 1000
        # The newest snapshot or run already outside the window anchors the cut: of
        # the commits up to it, later versions only read what it reads itself.
        anchors = [c for c in meta if c.kind in ("optimize", "run") and c.ts_ms <= horizon]
        if not anchors:
            return {"table": self.spec.name, "removed": 0}
        anchor = max(anchors, key=lambda c: c.commit)
        kept = set(self._active_dirs(anchor.commit))
        # The row first: a crash after it leaves directories that nothing reads,
        # not versions that can't be read. batch_id is the oldest readable commit.
        self._write_commit({"_commit": meta[-1].commit + 1, "kind": "vacuum", "batch_id": anchor.commit, "ts_ms": now_ms})
        removed = 0
        for c in meta:
            if c.kind in ("merge", "run", "optimize") and c.commit <= anchor.commit and self._dir(c) not in kept:
                removed += int(layout.delete_path(self.spark, self._dir(c)))
                if c.kind == "optimize":
                    for beside in (f"{self.zones_path}/_commit={c.commit}", f"{self.zones_path}/bounds-{c.commit}", f"{self.keys_path}/_commit={c.commit}"):
                        layout.delete_path(self.spark, beside)
        return {"table": self.spec.name, "removed": removed, "oldest_readable": anchor.commit}

    def unreachable(self, *, older_than_ms: int) -> DataFrame:
        """(directory, files, bytes) that no readable version opens, last written before ``older_than_ms``.

        Left by writes that failed before their commit row, or by a vacuum that was
        cut short. One listing job, anti-joined with the directories that the
        commits reach; a write under way is younger than any retention.
        """
        files = layout.list_files(self.spark, self.log_path, self.run_path, self.snapshot_path, self.zones_path, self.keys_path, times=True)
        place = files.select(F.regexp_extract("path", r"/((?:log|run|snapshot|_zones|_keys)/[^/]+)/", 1).alias("directory"), "length", "modified")
        held = place.groupBy("directory").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modified").alias("modified"))
        meta = self._meta()
        oldest = max((c.batch_id or 0 for c in meta if c.kind == "vacuum"), default=0)
        versions = [c.commit for c in meta if c.commit >= oldest]
        reached = {d for v in versions for d in self._active_dirs(v)} if len(versions) <= 1000 else {
            self._dir(c) for c in meta if c.kind in ("merge", "run", "optimize")}
        names = {d.removeprefix(f"{self.path}/") for d in reached}
        names |= {f"{beside}{d.removeprefix('snapshot/_commit=')}" for d in names if d.startswith("snapshot/")
                  for beside in ("_zones/_commit=", "_zones/bounds-", "_keys/_commit=")}
        live = self.spark.createDataFrame([(d,) for d in sorted(names)], "directory string")
        return held.join(live, "directory", "left_anti").where(F.unix_millis("modified") < older_than_ms).select("directory", "files", "bytes")

    def sweep(self, *, retain_hours: float = 168, allow_short_retention: bool = False, now_ms: int | None = None) -> list[str]:
        """Delete what ``unreachable`` finds, older than the retention window; returns the directories."""
        if retain_hours < 168 and not allow_short_retention:
            raise ValueError("retention below 168 hours needs allow_short_retention=True")
        now_ms = now_ms if now_ms is not None else int(time.time() * 1000)
        found = sorted(r.directory for r in self.unreachable(older_than_ms=int(now_ms - retain_hours * 3600 * 1000)).collect())
        return [d for d in found if layout.delete_path(self.spark, f"{self.path}/{d}")]


def _catalog_name(path: str) -> str:
    return f"keyfold_{hashlib.md5(path.encode()).hexdigest()}"


def register_views(spark: SparkSession, root: str, specs) -> list[str]:
    """One temp view per existing table (`<name>`) plus `<name>_live` without
    soft-deleted rows (S9, P14). Missing tables are skipped."""
    from keyfold.spec import table_path

    made = []
    for spec in specs:
        table = ChangeTable(spark, table_path(root, spec.name), spec)
        if not table.exists():
            continue
        df = table.read()
        df.createOrReplaceTempView(spec.name)
        df.filter(~F.col("_deleted")).createOrReplaceTempView(f"{spec.name}_live")
        made.append(spec.name)
    return made


def _key_bytes(spec: TableSpec, df: DataFrame):
    """Aggregate: bytes of the primary-key values of `df` (8 per fixed-width
    value, the UTF-8 length for strings), an upper bound on broadcasting them."""
    total = None
    for k in spec.primary_key:
        dtype = df.schema[k].dataType
        width = (F.coalesce(F.octet_length(F.col(f"`{k}`").cast("string")), F.lit(0))
                 if isinstance(dtype, (T.StringType, T.BinaryType)) else F.lit(8))
        total = width if total is None else total + width
    return F.sum(total + F.lit(16))  # plus per-row overhead
