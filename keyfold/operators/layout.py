"""Table layout jobs as ordinary Spark work.

* `file_stats`: the files a table directory really holds (including files a
  newer snapshot superseded), from a `binaryFile` listing: only `path` and
  `length` are read, never the content.
* `zordered`: multi-column clustering key. Each column is mapped to its
  rank bucket using approximate quantile bounds (one aggregate over the data,
  `buckets` bounds per column come back to the driver), the bucket ids are
  bit-interleaved into one long, and the caller range-partitions on it.
* `plan_files`: number of output files from the bytes on disk and a target size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_FILE_MB = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def make_dirs(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.mkdirs(jpath)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.delete(jpath, True)


def bytes_under(spark: SparkSession, path: str) -> int:
    """Total bytes under a directory, from the filesystem's own summary."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return 0
    return int(fs.getContentSummary(jpath).getLength())


def list_files(spark: SparkSession, *paths: str, times: bool = False) -> DataFrame:
    """(path, length) of every Parquet data file under `paths`, recursively, by one job; with `times` also `modified`."""
    schema = "path string, length long" + ", modified timestamp" * times
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], schema)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(there)
        .select("path", "length", *[F.col("modificationTime").alias("modified")] * times)
    )


def file_stats(spark: SparkSession, path: str, small_file_threshold_mb: int = SMALL_FILE_MB) -> DataFrame:
    """files, bytes, avg_file_bytes, small_files (C1). Missing path -> zeros."""
    return stats_of(list_files(spark, path), small_file_threshold_mb)


def stats_of(files: DataFrame, small_file_threshold_mb: int = SMALL_FILE_MB) -> DataFrame:
    threshold = small_file_threshold_mb * 1024 * 1024
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce(F.avg("length"), F.lit(0.0)).alias("avg_file_bytes"),
        F.count_if(F.col("length") < threshold).alias("small_files"),
    )


def fragmentation_report(spark: SparkSession, root: str, tables: Sequence[str],
                         small_file_threshold_mb: int = SMALL_FILE_MB) -> DataFrame:
    """Per-table files / small files / MiB / mean KiB (C12), one listing job."""
    threshold = small_file_threshold_mb * 1024 * 1024
    parts = []
    for t in tables:
        parts.append(list_files(spark, f"{root.rstrip('/')}/{t}").withColumn("table_name", F.lit(t)))
    if not parts:
        return spark.createDataFrame([], "table_name string, files long, small_files long, mib double, avg_kib double")
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return files.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("length") < threshold).alias("small_files"),
        (F.sum("length") / (1024 * 1024)).alias("mib"),
        (F.avg("length") / 1024).alias("avg_kib"),
    )


def reduction(before: int, after: int) -> float:
    """1 - after/before (C11); 0 when there was nothing before."""
    return 0.0 if before <= 0 else 1.0 - after / before


def plan_files(total_bytes: int, target_file_mb: float) -> int:
    return max(1, math.ceil(total_bytes / (target_file_mb * 1024 * 1024)))


def _literal(value) -> str:
    """A bound as SQL; infinities have no plain notation."""
    if isinstance(value, float):
        return f"CAST('{value}' AS DOUBLE)" if math.isinf(value) or math.isnan(value) else f"{value!r}D"
    return f"{value}L"


def _bucket_sql(column_sql: str, bounds: list) -> str:
    """SQL for the number of `bounds` (sorted, distinct) strictly below a value.

    A balanced tree of comparisons: log2(len(bounds)) comparisons per row, plain
    CASE WHEN inside whole-stage codegen, built as one expression string."""

    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return (f"CASE WHEN {_literal(bounds[mid])} < {column_sql} THEN {search(mid + 1, hi)} "
                f"ELSE {search(lo, mid)} END")

    if not bounds:
        return "CAST(0 AS BIGINT)"
    return f"CAST(CASE WHEN {column_sql} IS NULL THEN 0 ELSE {search(0, len(bounds))} END AS BIGINT)"


def _ranked_sql(df: DataFrame, c: str) -> str:
    """A number in the order of the column, so that ranges of it are ranges of files."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, T.NumericType):
        return f"CAST(`{c}` AS DOUBLE)"
    if isinstance(dtype, T.BooleanType):
        return f"CAST(`{c}` AS BIGINT)"
    if isinstance(dtype, T.DateType):
        return f"CAST(unix_date(`{c}`) AS BIGINT)"
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros(`{c}`)"
    if isinstance(dtype, T.TimestampNTZType):
        return f"unix_micros(CAST(`{c}` AS TIMESTAMP))"
    # text and bytes: their first seven bytes, which keep the byte order and fit a long
    return f"CAST(conv(rpad(hex(substring(CAST(`{c}` AS BINARY), 1, 7)), 14, '0'), 16, 10) AS BIGINT)"


def _ranked(df: DataFrame, c: str) -> Column:
    return F.expr(_ranked_sql(df, c))


def zorder_bits(n_files: int, n_columns: int) -> int:
    """Bits per column, enough for several buckets per file, at most 12 (4,095 bounds on the driver)."""
    return max(1, min(12, math.ceil((math.log2(max(2, n_files)) + 3) / n_columns)))


def zorder_bounds(stats: DataFrame, columns: Sequence[str], bits: int = 8) -> list[list[float]]:
    """Per-column quantile bounds (`2**bits - 1` each) in one aggregate job."""
    buckets = 1 << bits
    probs = [i / buckets for i in range(1, buckets)]
    row = stats.agg(*[F.percentile_approx(_ranked(stats, c), probs, 10000).alias(f"q{i}")
                      for i, c in enumerate(columns)]).first()
    return [sorted({b for b in (row[f"q{i}"] or []) if b is not None}) for i in range(len(columns))]


def _interleave(ids: list[Column], bits: int) -> Column:
    n = len(ids)
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for j, b in enumerate(ids):
            z = z + F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)), bit * n + j)
    return z


def zordered(df: DataFrame, columns: Sequence[str], bounds, bits: int = 8) -> DataFrame:
    """`df` plus `_z`, the interleaved bits of each column's quantile bucket (C4)."""
    names = [f"_zb{j}" for j in range(len(columns))]
    staged = df.select("*", *[F.expr(_bucket_sql(_ranked_sql(df, c), b)).alias(nm)
                              for c, b, nm in zip(columns, bounds, names)])
    return staged.withColumn("_z", _interleave([F.col(nm) for nm in names], bits)).drop(*names)


def clustered(df: DataFrame, n_files: int, *, zorder_by: Sequence[str] = (), partition_by: Sequence[str] = (),
              key: Sequence[str] = (), bounds: Sequence[list] | None = None, bits: int = 0) -> DataFrame:
    """Lay out `df` for writing in `n_files` ranges of even size.

    The order is (partition columns, z-value, its columns, `key`) with z-order, else
    (partition columns, row hash): the key or the hash splits what a hot value of
    the columns before would otherwise hold together. The quantiles for the z-value
    are `bounds` with `bits` (e.g. of the raw scans behind a fold: column-pruned, no
    shuffle), or else taken from `df`. Range bounds are sampled once per exchange and held by the driver,
    so a retried task routes rows the same way.
    """
    pcols = [F.col(f"`{c}`") for c in partition_by]
    if zorder_by:
        if bounds is None:
            bits = zorder_bits(n_files, len(zorder_by))
            bounds = zorder_bounds(df, zorder_by, bits)
        keyed = zordered(df, zorder_by, bounds, bits)
        # within a z-value by the columns themselves, which text needs (its number is a prefix)
        order = [*pcols, F.col("_z"), *[F.col(f"`{c}`") for c in dict.fromkeys([*zorder_by, *key])]]
    else:
        keyed = df.withColumn("_z", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        order = [*pcols, F.col("_z")]
    return keyed.repartitionByRange(n_files, *order).sortWithinPartitions(*order).drop("_z")
