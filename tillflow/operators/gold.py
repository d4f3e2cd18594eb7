"""Daily sales by category and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions.parsing import UNKNOWN
from tillflow.functions.retail import average

CELL = ["order_date", "category", "region"]


def daily_sales(orders: DataFrame, products: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Net revenue, distinct orders, units and average order value per cell.

    An order whose product is not in the reference counts under `Unknown`; its
    revenue is never dropped. Spark broadcasts the reference only while its
    measured size allows, and splits a hot product when it does not.

    `unique_orders` is for callers that prove order ids unique before they
    publish (see `validate.gate`): rows can then be counted in place of distinct
    ids, which leaves one small shuffle of partial sums.
    """
    order_count = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    lines = orders.select("order_id", "order_date", "product_id", "region", "quantity", "line_revenue")
    categories = products.select("product_id", F.col("category").alias("_category"))
    return (
        lines.join(categories, "product_id", "left")
        .withColumn("category", F.coalesce("_category", F.lit(UNKNOWN)))
        .groupBy(*CELL)
        .agg(
            F.sum("line_revenue").alias("_revenue"),
            order_count.alias("order_count"),
            F.sum("quantity").cast("bigint").alias("units_sold"),
        )
        .select(
            *CELL,
            F.col("_revenue").cast("decimal(18,2)").alias("net_revenue"),
            "order_count",
            "units_sold",
            average(F.col("_revenue"), F.col("order_count"), "decimal(18,2)").alias("aov"),
        )
    )


SUMS = ["net_revenue", "order_count", "units_sold"]


def cell_changes(changes: DataFrame, products: DataFrame) -> DataFrame:
    """By how much order changes move each cell's sums; cells whose sums stay are left out.

    Every sum of a cell adds up over orders, whose ids are unique, so a retracted
    version counts as minus one order.
    """
    sign = F.when(F.col("kind") == schemas.RETRACTED, -1).otherwise(1)
    categories = products.select("product_id", F.col("category").alias("_category"))
    return (
        changes.filter(F.col("kind").isin(schemas.RETRACTED, schemas.ADDED)).join(categories, "product_id", "left")
        .withColumns({"category": F.coalesce("_category", F.lit(UNKNOWN)), "_sign": sign})
        .groupBy(*CELL)
        .agg(
            F.sum(F.col("line_revenue") * F.col("_sign")).cast("decimal(18,2)").alias("net_revenue"),
            F.sum("_sign").cast("bigint").alias("order_count"),
            F.sum(F.col("quantity") * F.col("_sign")).cast("bigint").alias("units_sold"),
        )
        .filter(" OR ".join(f"{name} <> 0" for name in SUMS))
    )


def apply_changes(cells: DataFrame, moved: DataFrame) -> DataFrame:
    """Cells with their sums moved; those that no order is left in are gone."""
    columns = [*CELL, *SUMS]
    sums = cells.select(*columns).unionByName(moved.select(*columns)).groupBy(*CELL).agg(
        F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
        *[F.sum(name).cast("bigint").alias(name) for name in SUMS[1:]],
    )
    return sums.filter("order_count <> 0").withColumn(
        "aov", average(F.col("net_revenue").cast("decimal(24,2)"), F.col("order_count"), "decimal(18,2)")
    )


def sales_report(gold: DataFrame) -> DataFrame:
    columns = [*CELL, "net_revenue", "order_count", "units_sold", "aov"]
    return gold.select(*columns).orderBy(*CELL)
