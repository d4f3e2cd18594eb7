"""Customer concentration and repeat purchase."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.retail import share
from tillflow.operators.ranking import largest_values
from tillflow.operators.retail.lines import sale_lines
from tillflow.schemas import RETAIL_MONEY

# Fixed value: the customer shares reported, in percent.
TOP_PERCENTS = [1, 5, 10, 20]


def customer_summary(analysis: DataFrame) -> DataFrame:
    """Sales and orders of each identified customer."""
    return (
        sale_lines(analysis)
        .dropna(subset=["customer_id"])
        .groupBy("customer_id")
        .agg(F.sum("line_value").cast(RETAIL_MONEY).alias("gross_sales"), F.countDistinct("invoice").alias("orders"))
    )


def customer_concentration(summary: DataFrame, percents: Iterable[int] = TOP_PERCENTS) -> DataFrame:
    """Share of sales held by the top customers, by whole percent of customers.

    A level covers at least one customer and rounds up; the cut is worked out in
    integers, so a level that divides evenly takes no customer too many.
    """
    percents = list(percents)
    found = largest_values(summary, "gross_sales", percents=percents)
    levels = []
    for p in percents:
        cut = max(1, -(-found.rows * p // 100))
        top = F.lit(found.sums[cut]).cast(RETAIL_MONEY)
        levels.append(F.struct(
            F.lit(p).alias("top_percent"), F.lit(cut).cast("bigint").alias("customers"), top.alias("gross_sales"),
            share(top, F.lit(found.total)).alias("sales_share"),
        ))
    return summary.sparkSession.range(1).select(F.inline(F.array(*levels)))


def repeat_purchase(summary: DataFrame) -> DataFrame:
    """One order against two or more: customers, their share, their revenue share."""
    segments = {"One order": F.col("orders") == 1, "Two or more orders": F.col("orders") >= 2}
    sums = summary.agg(
        F.count("*").alias("customers"),
        F.sum("gross_sales").alias("sales"),
        *[F.count_if(member).alias(f"{name} customers") for name, member in segments.items()],
        *[
            F.sum(F.when(member, F.col("gross_sales"))).alias(f"{name} sales")
            for name, member in segments.items()
        ],
    )
    rows = [
        F.struct(
            F.lit(name).alias("segment"),
            F.col(f"{name} customers").alias("customers"),
            share(F.col(f"{name} customers"), F.col("customers")).alias("customer_share"),
            share(F.coalesce(F.col(f"{name} sales"), F.lit(0)), F.col("sales")).alias("revenue_share"),
        )
        for name in segments
    ]
    return sums.select(F.inline(F.array(*rows)))
