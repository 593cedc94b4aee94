"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_millis(df: DataFrame, column: str) -> Column:
    """Milliseconds since the epoch (truncated). A TIMESTAMP_NTZ is read as UTC
    wall time, so the result is the same under any session time zone."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column))
    return F.unix_millis(F.col(column))
