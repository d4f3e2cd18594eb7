"""Sales by country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.retail import share
from tillflow.operators.retail.lines import sale_lines
from tillflow.schemas import RETAIL_MONEY


def country_summary(analysis: DataFrame) -> DataFrame:
    """Sales, orders, customers and share of all sales per country.

    Lines without a country have no row of their own but stay in the total. They
    are left out after the grouping: filtered before it, the total would need a
    second pass over the lines instead of sharing one.
    """
    grouped = (
        sale_lines(analysis)
        .groupBy("country")
        .agg(
            F.sum("line_value").cast(RETAIL_MONEY).alias("gross_sales"),
            F.countDistinct("invoice").alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            F.count("country").alias("named_lines"),
        )
    )
    total = sale_lines(analysis).agg(F.sum("line_value")).scalar()
    named = grouped.filter(F.col("named_lines") > 0).drop("named_lines")
    return named.withColumn("sales_share", share(F.col("gross_sales"), total))


def top_countries(summary: DataFrame, n: int = 10) -> DataFrame:
    return summary.orderBy(F.desc("gross_sales"), F.asc("country")).limit(n)


def share_of_country(summary: DataFrame, country: str) -> DataFrame:
    return summary.filter(F.col("country") == country).select("country", "sales_share")
