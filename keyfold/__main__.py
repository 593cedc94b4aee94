"""Command line: `python -m keyfold <command> ...` over the library.

  stream    run one checkpointed query per table (--once drains and stops)
  maintain  compact + z-order + vacuum every existing table
  history   commit history of one table
  stats     data files per table (fragmentation report)
  query     named analytical queries over the lake's tables (keeps going past failures)
  catalog   registered queries over a folder of base tables
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from keyfold.spec import TABLE_SPECS, get_spec, table_path


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="keyfold", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--lake", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--source", help="folder of Kafka-shaped record files, one subfolder per topic")
    s.add_argument("--bootstrap-servers")
    s.add_argument("--tables", nargs="*", default=[t.name for t in TABLE_SPECS])
    s.add_argument("--once", action="store_true")
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--starting-offsets", default="earliest", help="earliest or latest; Kafka: also a JSON of offsets")
    s.add_argument("--max-offsets-per-trigger", type=int, default=20_000)
    s.add_argument("--max-files-per-trigger", type=int, default=1000)
    s.add_argument("--max-bytes-per-trigger", help="for folders, instead of a number of files, such as 512m")
    s.add_argument("--max-records-per-commit", type=int, help="for folders: a micro-batch is applied in slices of so many records")
    s.add_argument("--timeout", type=float)
    m = sub.add_parser("maintain")
    m.add_argument("--levelled", action="store_true", help="merge small commits level by level; fold the whole table only when the log has grown")
    m.add_argument("--lake", required=True)
    m.add_argument("--retain-hours", type=float, default=168)
    m.add_argument("--target-mb", type=float, default=128)
    m.add_argument("--skip-vacuum", action="store_true")
    m.add_argument("--allow-short-retention", action="store_true")
    h = sub.add_parser("history")
    h.add_argument("--lake", required=True)
    h.add_argument("--table", required=True)
    h.add_argument("--limit", type=int, default=20)
    st = sub.add_parser("stats")
    st.add_argument("--lake", required=True)
    q = sub.add_parser("query")
    q.add_argument("--lake", required=True)
    q.add_argument("names", nargs="*")
    q.add_argument("--limit", type=int, default=50)
    c = sub.add_parser("catalog")
    c.add_argument("--sf-dir", required=True)
    c.add_argument("names", nargs="*")
    c.add_argument("--limit", type=int, default=50)
    return p


def _lake_queries(spark: SparkSession, lake: str) -> dict:
    from keyfold.plans import analytics as K
    from keyfold.table import ChangeTable

    def table(name):
        return ChangeTable(spark, table_path(lake, name), get_spec(name)).read()

    return {
        "order_book_by_status": lambda: K.order_book_by_status(table("orders")),
        "order_line_variance": lambda: K.order_line_variance(table("orders"), table("order_items")),
        "replenishment_shortfall": lambda: K.replenishment_shortfall(table("inventory")),
        "freshness": lambda: K.freshness({t.name: table(t.name) for t in TABLE_SPECS}, with_lag=True),
        "op_mix": lambda: K.op_mix(table("orders")),
        "customers_tier_coverage": lambda: K.evolution_coverage(table("customers"), "loyalty_tier"),
        "bench_point_lookup_all_rows": lambda: K.bench_point_lookup_all_rows(table("orders")),
        "bench_range_all_rows": lambda: K.bench_range_all_rows(table("orders")),
        "bench_status_agg": lambda: K.bench_status_agg(table("orders")),
        "bench_join": lambda: K.bench_join(table("orders"), table("order_items")),
        "bench_low_stock_all_rows": lambda: K.bench_low_stock_all_rows(table("inventory")),
        "bench_full_count_all_rows": lambda: K.bench_full_count_all_rows(table("order_items")),
    }


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("keyfold").getOrCreate()
    out: object
    if args.command == "stream":
        from keyfold.streaming.sink import StreamConfig, ingested, run_streams

        cfg = StreamConfig(lake_root=args.lake, checkpoint_root=args.checkpoints, source_root=args.source,
                           bootstrap_servers=args.bootstrap_servers, trigger_interval=args.trigger,
                           starting_offsets=args.starting_offsets, max_offsets_per_trigger=args.max_offsets_per_trigger,
                           max_files_per_trigger=args.max_files_per_trigger, max_bytes_per_trigger=args.max_bytes_per_trigger,
                           max_records_per_commit=args.max_records_per_commit)
        specs = [get_spec(t) for t in args.tables]
        _, failures = run_streams(spark, cfg, specs, once=args.once, timeout_seconds=args.timeout)
        out = {"streams": [r.asDict() for r in ingested(spark, cfg, specs).collect()], "failures": failures}
    elif args.command == "maintain":
        from keyfold.plans.maintenance import maintain

        df = maintain(spark, args.lake, TABLE_SPECS, retain_hours=args.retain_hours,
                      target_file_mb=args.target_mb, skip_vacuum=args.skip_vacuum,
                      allow_short_retention=args.allow_short_retention, levelled=args.levelled)
        out = [r.asDict() for r in df.collect()]
    elif args.command == "history":
        from keyfold.table import ChangeTable

        t = ChangeTable(spark, table_path(args.lake, args.table), get_spec(args.table))
        out = [r.asDict() for r in t.history(args.limit).drop("schema_json").collect()]
    elif args.command == "stats":
        from keyfold.operators.layout import fragmentation_report

        out = [r.asDict() for r in fragmentation_report(spark, args.lake, [t.name for t in TABLE_SPECS]).collect()]
    elif args.command == "query":
        from keyfold.plans.runner import run_named

        qs = _lake_queries(spark, args.lake)
        out = run_named({n: qs[n] for n in (args.names or qs)}, limit=args.limit)
    else:
        from keyfold.plans.catalog import QUERIES
        from keyfold.plans.runner import run_named

        out = run_named({n: (lambda n=n: QUERIES[n](spark, args.sf_dir)) for n in (args.names or QUERIES)},
                        limit=args.limit)
    print(json.dumps(out, indent=2, default=str))
    failed = isinstance(out, dict) and (out.get("failures") or any(
        isinstance(v, dict) and "error" in v for v in out.values()))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
