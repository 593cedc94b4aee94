"""keyfold: change-data-capture tables on Spark DataFrames and Structured Streaming.

Row-level change events (JSON envelopes carrying before/after images, an op code
and a log sequence number) become queryable tables through ordinary Spark jobs:
parse -> infer -> flatten -> collapse per key -> guarded fold -> Parquet.
"""

from keyfold.spec import TABLE_SPECS, TableSpec, get_spec

__all__ = ["TABLE_SPECS", "TableSpec", "get_spec"]
