"""Run a set of named queries (K12) and time them.

`run_named` keeps going past a failing query and reports it, like a query
file runner; `time_queries` is the latency harness: one warm-up, then `runs`
timed executions through the `noop` sink, median reported.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

DISPLAY_LIMIT = 50


def run_named(queries: Mapping[str, Callable[[], DataFrame]], *, limit: int | None = DISPLAY_LIMIT) -> dict:
    """name -> {"rows": [...] (capped at `limit` for display), "seconds"} or {"error": ...}."""
    out: dict[str, dict] = {}
    for name, build in queries.items():
        started = time.perf_counter()
        try:
            df = build()
            rows = (df.limit(limit) if limit is not None else df).collect()
            out[name] = {"rows": [r.asDict(recursive=True) for r in rows], "columns": df.columns,
                         "seconds": round(time.perf_counter() - started, 3)}
        except Exception as exc:  # noqa: BLE001 - keep going past one bad query
            out[name] = {"error": f"{type(exc).__name__}: {exc}"[:500],
                         "seconds": round(time.perf_counter() - started, 3)}
    return out


def time_queries(queries: Mapping[str, Callable[[], DataFrame]], *, runs: int = 7) -> dict[str, float]:
    """Median seconds per query over `runs` executions after one warm-up."""
    results = {}
    for name, build in queries.items():
        df = build()
        df.write.format("noop").mode("overwrite").save()  # warm-up
        timings = []
        for _ in range(runs):
            started = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - started)
        results[name] = round(statistics.median(timings), 4)
    return results
