"""Product ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.retail.lines import sale_lines
from tillflow.schemas import RETAIL_MONEY


def product_summary(analysis: DataFrame) -> DataFrame:
    """Sales, units and orders per product-like code."""
    return (
        sale_lines(analysis)
        .filter("is_product_like_code")
        .groupBy("stock_code")
        .agg(
            F.sum("line_value").cast(RETAIL_MONEY).alias("gross_sales"),
            F.sum("quantity").cast("bigint").alias("units"),
            F.countDistinct("invoice").alias("orders"),
        )
    )


def description_mode(analysis: DataFrame) -> DataFrame:
    """The most frequent description of each code, the first by spelling on a tie.

    Lines fold to counts before anything moves, and the choice per code is an
    aggregate, so a code with very many lines or spellings is never one group.
    """
    counted = (
        sale_lines(analysis)
        .filter(F.col("stock_code").isNotNull() & F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(F.count("*").alias("lines"))
    )
    best = F.min(F.struct((-F.col("lines")).alias("fewer"), F.col("description"))).alias("best")
    return counted.groupBy("stock_code").agg(best).select(
        "stock_code",
        F.col("best.description").alias("description"),
        (-F.col("best.fewer")).alias("line_count"),
    )


def top_products(analysis: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling product-like codes, with their usual description.

    The ranking is cut to `n` codes first, so descriptions are only worked out
    for lines of those codes.
    """
    best = product_summary(analysis).orderBy(F.desc("gross_sales"), F.asc("stock_code")).limit(n)
    # At most n rows.
    ranked_lines = analysis.join(F.broadcast(best.select("stock_code")), "stock_code", "left_semi")
    lookup = description_mode(ranked_lines).select("stock_code", "description")
    return best.join(lookup, "stock_code", "left").select("stock_code", "description", "gross_sales", "units", "orders")
