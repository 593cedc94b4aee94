"""The analytical queries over change tables (K1-K5, K8, K9), as DataFrames.

Every function takes table states (the output of a read/resolve) and returns a
lazy DataFrame; Catalyst prunes columns and pushes the filters to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.money import MONEY, avg_money, money, money_sum
from keyfold.functions.predicates import live


def order_book_by_status(orders: DataFrame) -> DataFrame:
    """K1: live orders per status with revenue and mean order value."""
    return (
        live(orders)
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money_sum(F.col("total_amount")).alias("revenue"),
            avg_money(F.col("total_amount")).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "status")
    )


def order_line_variance(orders: DataFrame, items: DataFrame, limit: int = 20) -> DataFrame:
    """K2: orders whose header total disagrees with their lines, worst first.

    Lines are aggregated per order *before* the join (map-side partial
    aggregation), so the join is one-to-one and an order with a huge number of
    lines costs one row, not a skewed join partition.
    """
    per_order = (
        live(items)
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("line_count"),
            F.sum(F.col("quantity") * money(F.col("unit_price"))).alias("_lines"),
        )
    )
    o = live(orders).select("order_id", "status", "total_amount")
    joined = o.join(per_order, "order_id")
    variance = (money(F.col("total_amount")) - F.col("_lines")).cast(MONEY)
    return (
        joined.select(
            "order_id",
            "status",
            "total_amount",
            "line_count",
            F.col("_lines").cast(MONEY).alias("computed_total"),
            variance.alias("variance"),
        )
        .filter(F.abs(F.col("variance")) > F.lit(0.01))
        .orderBy(F.abs(F.col("variance")).desc(), F.col("order_id"))
        .limit(limit)
    )


def replenishment_shortfall(inventory: DataFrame, limit: int = 25) -> DataFrame:
    """K4: live stock rows below their reorder level, largest shortfall first."""
    return (
        live(inventory)
        .filter(F.col("quantity") < F.col("reorder_level"))
        .select(
            "product_id",
            "warehouse_id",
            "quantity",
            "reorder_level",
            (F.col("reorder_level") - F.col("quantity")).alias("shortfall"),
        )
        .orderBy(F.desc("shortfall"), "product_id", "warehouse_id")
        .limit(limit)
    )


def freshness(tables: dict[str, DataFrame], *, with_lag: bool = False) -> DataFrame:
    """K3: highest absorbed log position per table (UNION ALL of aggregates).

    With `with_lag`, also the last write time and the lag between a change
    at the source and its arrival (`_ingested_at - _source_ts_ms`, in seconds).
    """
    parts = []
    for name, df in tables.items():
        aggs = [F.lit(name).alias("table_name"), F.max("_lsn").alias("max_lsn")]
        if with_lag:
            aggs += [
                F.max("_ingested_at").alias("last_write"),
                F.max(F.unix_millis("_ingested_at") - F.col("_source_ts_ms")).alias("_lag_ms"),
            ]
        parts.append(df.agg(*aggs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if with_lag:
        out = out.withColumn("max_lag_seconds", F.col("_lag_ms") / 1000).drop("_lag_ms")
    return out.orderBy("table_name")


def op_mix(orders: DataFrame) -> DataFrame:
    """K5: rows per last operation, with how many of them are deleted."""
    return (
        orders.groupBy("_op")
        .agg(F.count(F.lit(1)).alias("event_rows"), F.count_if(F.col("_deleted")).alias("deleted_rows"))
        .orderBy(F.desc("event_rows"), "_op")
    )


def op_deleted_mix(table: DataFrame) -> DataFrame:
    """Rows per (last op, deleted flag)."""
    return table.groupBy("_op", "_deleted").agg(F.count(F.lit(1)).alias("rows"))


def evolution_coverage(table: DataFrame, column: str, label: str = "(not set)") -> DataFrame:
    """K8: live rows with and without a column added mid-stream."""
    return (
        live(table)
        .groupBy(F.coalesce(F.col(column), F.lit(label)).alias(column))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), column)
    )


# ---- K9: the benchmark set. The reference's versions of point lookup, range,
# low stock and full count do not filter soft deletes; kept as `*_all_rows`.


def bench_point_lookup_all_rows(orders: DataFrame, order_id: int = 42) -> DataFrame:
    return orders.filter(F.col("order_id") == F.lit(order_id))


def bench_range_all_rows(orders: DataFrame, lo: int = 100, hi: int = 140) -> DataFrame:
    return orders.filter(F.col("customer_id").between(lo, hi)).select("order_id", "status", "total_amount")


def bench_status_agg(orders: DataFrame) -> DataFrame:
    return (
        live(orders)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("total_amount")).alias("revenue"))
        .orderBy(F.desc("revenue"), "status")
    )


def bench_join(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines and line value per order status; lines pre-aggregated per order."""
    per_order = live(items).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("quantity") * money(F.col("unit_price"))).alias("_v"),
    )
    return (
        live(orders)
        .select("order_id", "status")
        .join(per_order, "order_id")
        .groupBy("status")
        .agg(F.sum("_n").alias("lines"), F.sum("_v").cast(MONEY).alias("value"))
    )


def bench_low_stock_all_rows(inventory: DataFrame) -> DataFrame:
    return (
        inventory.filter(F.col("quantity") < F.col("reorder_level"))
        .select("product_id", "warehouse_id", "quantity", "reorder_level")
        .orderBy("quantity", "product_id", "warehouse_id")
    )


def bench_full_count_all_rows(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("rows"))
