"""Sales over time."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.retail import average, share
from tillflow.operators.retail.lines import sale_lines
from tillflow.schemas import RETAIL_MONEY

# The season compared, and the last month of the compared year.
SEASON_MONTHS = [9, 10, 11]
LAST_COMPARED_MONTH = 11


def monthly_sales(analysis: DataFrame) -> DataFrame:
    """Gross sales, orders, identified customers and order value per month."""
    return (
        sale_lines(analysis)
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            F.sum("line_value").cast(RETAIL_MONEY).alias("gross_sales"),
            F.countDistinct("invoice").alias("orders"),
            F.countDistinct("customer_id").alias("identified_customers"),
        )
        .withColumn("average_order_value", average(F.col("gross_sales"), F.col("orders"), RETAIL_MONEY))
    )


def selected_months(monthly: DataFrame, months: Iterable[date]) -> DataFrame:
    return monthly.filter(F.col("month").isin(list(months)))


def peak_months(monthly: DataFrame, data_end: Column) -> DataFrame:
    """The best complete month of each year; a month cut off by `data_end` is left out."""
    best_first = Window.partitionBy("year").orderBy(F.desc("gross_sales"), F.asc("month"))
    return (
        monthly.filter(F.last_day("month") <= data_end)
        .withColumn("year", F.year("month"))
        .withColumn("_rank", F.row_number().over(best_first))
        .filter(F.col("_rank") == 1)
        .select("year", "month", "gross_sales")
    )


def seasonality_share(monthly: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """September to November as a share of January to November, by year.

    December is never read: in the last year of an extract it is cut short.
    """
    dated = monthly.withColumn("year", F.year("month"))
    if years is not None:
        dated = dated.filter(F.col("year").isin(list(years)))
    in_season = F.month("month").isin(SEASON_MONTHS)
    return (
        dated.filter(F.month("month") <= LAST_COMPARED_MONTH)
        .groupBy("year")
        .agg(
            F.sum("gross_sales").cast(RETAIL_MONEY).alias("jan_nov_sales"),
            F.coalesce(F.sum(F.when(in_season, F.col("gross_sales"))), F.lit(0)).cast(RETAIL_MONEY).alias("sep_nov_sales"),
        )
        .withColumn("sep_nov_share", share(F.col("sep_nov_sales"), F.col("jan_nov_sales")))
    )
