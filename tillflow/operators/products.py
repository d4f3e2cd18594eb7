"""Conforming the product reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import parsing


def conform_products(raw: DataFrame) -> DataFrame:
    """One typed row per product id.

    Where an id repeats, the greatest row wins, comparing name, category and
    price in turn with a missing value lowest, so the choice never varies.
    """
    typed = raw.select(
        F.trim("product_id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        parsing.category(F.col("category")).alias("category"),
        parsing.list_price(F.col("list_price")).alias("list_price"),
    ).filter(F.col("product_id").isNotNull() & (F.col("product_id") != ""))
    greatest = F.max(F.struct("product_name", "category", "list_price")).alias("row")
    return typed.groupBy("product_id").agg(greatest).select("product_id", "row.*")
