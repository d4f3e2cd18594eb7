"""One row per order: the version its source asserted last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import parsing


def with_record_hash(valid: DataFrame) -> DataFrame:
    business = [F.col(name) for name in schemas.ORDER_FIELDS]
    return valid.withColumn("_record_hash", parsing.record_hash(*business))


def with_line_facts(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "line_revenue": (F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)"),
            "is_return": F.col("quantity") < 0,
            "is_zero_quantity": F.col("quantity") == 0,
        }
    )


def latest_version(valid: DataFrame) -> DataFrame:
    """Keep the last version of each order, in Silver shape.

    Asking for row number 1 lets Spark keep one row per order in every map task
    (`WindowGroupLimit`, partial), so an order re-sent a billion times reaches
    its reducer as one row per task. The drift flag closes the total order. Hashes move as
    bytes, which are in the order of their hex text.
    """
    newest_first = Window.partitionBy("order_id").orderBy(
        F.desc_nulls_last("_source_batch_date"),
        F.desc_nulls_last("_ingested_at"),
        F.desc_nulls_last("_source_file"),
        F.desc_nulls_last("_record_hash"),
        F.desc_nulls_last("has_schema_drift"),
    )
    newest = (
        with_record_hash(valid)
        .withColumn("_record_hash", F.unhex("_record_hash"))
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .withColumn("_record_hash", F.lower(F.hex("_record_hash")))
    )
    return with_line_facts(newest).select(*schemas.SILVER_ORDERS.names)
