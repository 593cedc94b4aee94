"""Row history: validity intervals of every change.

`valid_to_lsn` of a change is the LSN of the next change to the same key. A
plain `lead() OVER (PARTITION BY key ORDER BY lsn)` puts every change of a key
into one task, so a key holding a third of the log would be one task. Here the
log is range-partitioned on (key, lsn) (sampled bounds split a hot key across
partitions); `lead` runs per (key, range partition), and only the first row of
each (key, partition) piece takes part in a second, small `lead` across
pieces: at most one row per key per range partition.

The piece assignment is used by two branches of the plan; range bounds are
sampled per exchange, so it is materialised once with a reliable checkpoint
in the session's shared checkpoint folder (lineage cut, survives executor loss).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.session import shared_root


def row_history(changes: DataFrame, primary_key: Sequence[str], *, partitions: int | None = None) -> DataFrame:
    pk = [F.col(f"`{c}`") for c in primary_key]
    n = partitions or int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_root(changes.sparkSession)
    ranged = (
        changes.repartitionByRange(n, *pk, F.col("_lsn"))
        .withColumn("_piece", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    in_piece = Window.partitionBy(*pk, "_piece").orderBy("_lsn")
    marked = (
        ranged.withColumn("_next", F.lead("_lsn").over(in_piece))
        .withColumn("_first", F.row_number().over(in_piece) == 1)
    )
    # First row of every (key, piece): the piece's start. Its successor piece's
    # start is the end of this piece's last row.
    starts = marked.filter("_first").select(*pk, "_piece", F.col("_lsn").alias("_start"))
    across = Window.partitionBy(*pk).orderBy("_piece")
    ends = starts.withColumn("_piece_end", F.lead("_start").over(across)).drop("_start")
    out = marked.join(ends, [*primary_key, "_piece"], "left")
    return out.select(
        *[c for c in changes.columns],
        F.col("_lsn").alias("valid_from_lsn"),
        F.coalesce(F.col("_next"), F.col("_piece_end")).alias("valid_to_lsn"),
    ).withColumn("is_current", F.col("valid_to_lsn").isNull())
