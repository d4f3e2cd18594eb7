"""Derived fields of a retail line, and the populations built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import retail


def with_line_flags(lines: DataFrame) -> DataFrame:
    quantity, price, invoice = F.col("quantity"), F.col("unit_price"), F.col("invoice")
    return lines.withColumns(
        {
            "line_value": quantity * price,
            "is_cancel_invoice": retail.is_cancel_invoice(invoice),
            "is_sale_line": retail.is_sale(quantity, price, invoice),
            "is_negative_line": retail.is_negative(quantity, price),
            "is_product_like_code": retail.is_product_like(F.col("stock_code")),
            "month": F.trunc("invoice_date", "month"),
        }
    )


def sale_lines(analysis: DataFrame) -> DataFrame:
    return analysis.filter("is_sale_line")


def negative_lines(analysis: DataFrame) -> DataFrame:
    """Negative lines with their value turned positive."""
    return analysis.filter("is_negative_line").withColumn("negative_value", -F.col("line_value"))
