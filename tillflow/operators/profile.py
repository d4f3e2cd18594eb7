"""Profiles of what landed, loaded and was set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def landing_profile(bronze: DataFrame) -> DataFrame:
    """Per source file: rows, rows with drift, distinct raw date texts."""
    return bronze.groupBy("_source_file").agg(
        F.count("*").alias("rows_landed"),
        F.count("_rescued_data").alias("rows_with_schema_drift"),
        F.countDistinct("order_date").alias("distinct_raw_dates"),
    )


def bronze_summary(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count("*").alias("bronze_rows"),
        F.countDistinct("_source_file").alias("source_files"),
        F.min("_ingested_at").alias("first_ingested_at"),
        F.max("_ingested_at").alias("last_ingested_at"),
    )


def version_counts(bronze: DataFrame) -> DataFrame:
    """Order ids that arrived more than once."""
    counted = bronze.groupBy("order_id").agg(F.count("*").alias("bronze_versions"))
    return counted.filter(F.col("bronze_versions") > 1)


def rows_per_date(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date").agg(F.count("*").alias("row_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts in long form, one row per table."""
    counts = [frame.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, frame in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def reject_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("row_count"))


def restatement_check(orders: DataFrame, order_ids: DataFrame) -> DataFrame:
    """The stored version of the given orders, to show which file it came from."""
    columns = ["order_id", "order_date", "quantity", "unit_price", "line_revenue", "_source_file"]
    return orders.join(order_ids.select("order_id"), "order_id", "left_semi").select(*columns)


def distinct_counts(frame: DataFrame, columns: list[str]) -> list[Column]:
    """The number of distinct values of each column, from a grouping of its own.

    Counted beside each other, every row would be expanded into one row for each column.
    """
    return [
        frame.select(name).distinct().agg(F.count(name)).scalar().alias(f"distinct_{name}") for name in columns
    ]
