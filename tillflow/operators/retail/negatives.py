"""Negative transactions and extreme lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.retail import share
from tillflow.operators.retail.lines import negative_lines
from tillflow.schemas import RETAIL_MONEY

# The two labels of the breakdown.
PRODUCT_LIKE = "Product-like stock code"
ADMINISTRATIVE = "Non-product-like / administrative code"

LINE = ["invoice", "invoice_date", "stock_code", "description", "quantity", "unit_price"]
BUYER = ["customer_id", "country"]


def negative_breakdown(analysis: DataFrame) -> DataFrame:
    """Negative value by kind of code, with its share."""
    grouped = (
        negative_lines(analysis)
        .withColumn("code_group", F.when(F.col("is_product_like_code"), PRODUCT_LIKE).otherwise(ADMINISTRATIVE))
        .groupBy("code_group")
        .agg(F.sum("negative_value").cast(RETAIL_MONEY).alias("negative_value"), F.count("*").alias("row_count"))
    )
    total = negative_lines(analysis).agg(F.sum("negative_value")).scalar()
    return grouped.withColumn("negative_value_share", share(F.col("negative_value"), total))


def top_negative_lines(analysis: DataFrame, n: int = 12) -> DataFrame:
    columns = [*LINE, "negative_value", *BUYER]
    ties = [F.asc(name) for name in columns if name != "negative_value"]
    return negative_lines(analysis).select(*columns).orderBy(F.desc("negative_value"), *ties).limit(n)


def extreme_lines(analysis: DataFrame, n: int = 15) -> DataFrame:
    """The lines of greatest absolute value, for review rather than removal."""
    columns = [*LINE, "line_value", *BUYER]
    ties = [F.asc(name) for name in columns]
    return (
        analysis.filter(F.col("line_value").isNotNull())
        .select(*columns)
        .orderBy(F.desc(F.abs("line_value")), *ties)
        .limit(n)
    )
