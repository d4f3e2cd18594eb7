"""Typing, classification and the valid / rejected split of raw order rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import parsing


def reject_reason() -> Column:
    """The first failing check of a typed row, null for a good one.

    The order is part of the contract: the reason named is always the most
    fundamental problem of the row. The names are fixed values.
    """
    return (
        F.when(F.col("order_id").isNull() | (F.col("order_id") == ""), "missing_order_id")
        .when(F.col("order_date").isNull(), "unparseable_order_date")
        .when(F.col("quantity").isNull(), "missing_or_invalid_quantity")
        .when(F.col("unit_price").isNull(), "missing_or_invalid_unit_price")
        .when(F.col("unit_price") < 0, "negative_unit_price")
    )


def classify(bronze: DataFrame) -> DataFrame:
    """Typed values beside the raw text they came from, plus `reject_reason`."""
    raw = F.col
    typed = bronze.select(
        F.trim(raw("order_id")).alias("order_id"),
        parsing.order_date(raw("order_date")).alias("order_date"),
        parsing.blank_to_null(raw("customer_id")).alias("customer_id"),
        F.trim(raw("product_id")).alias("product_id"),
        parsing.quantity(raw("quantity")).alias("quantity"),
        parsing.unit_price(raw("unit_price")).alias("unit_price"),
        parsing.region(raw("region")).alias("region"),
        raw("_rescued_data").isNotNull().alias("has_schema_drift"),
        raw("_source_file"),
        parsing.file_date(raw("_source_file")).alias("_source_batch_date"),
        raw("_ingested_at"),
        raw("order_date").alias("order_date_raw"),
        raw("quantity").alias("quantity_raw"),
        raw("unit_price").alias("unit_price_raw"),
        raw("region").alias("region_raw"),
    )
    return typed.withColumn("reject_reason", reject_reason())


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull())


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Rejected rows in quarantine shape, with the raw text kept."""
    columns = [name for name in schemas.QUARANTINE.names if name != "_quarantined_at"]
    return classified.filter(F.col("reject_reason").isNotNull()).select(*columns)


def needed_form(classified: DataFrame) -> DataFrame:
    """Classified rows in the form each is needed in from here on: valid ones as values, rejected ones as their raw text."""
    good = F.col("reject_reason").isNull()
    values = ["order_date", "quantity", "unit_price", "region", "has_schema_drift", "_source_batch_date"]
    raw = ["order_date_raw", "quantity_raw", "unit_price_raw", "region_raw"]
    return classified.withColumns({
        **{name: F.when(good, F.col(name)) for name in values}, **{name: F.when(~good, F.col(name)) for name in raw},
    })
