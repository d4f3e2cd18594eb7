"""Headline numbers, overview and the data-quality scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions import retail
from tillflow.functions.retail import share
from tillflow.operators.retail.lines import with_line_flags
from tillflow.schemas import RETAIL_MONEY


def _total(condition: Column, sign: int = 1) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("line_value") * sign)), F.lit(0)).cast(RETAIL_MONEY)


def headline_metrics(analysis: DataFrame) -> DataFrame:
    """Gross, negative and net value, and the rates read from them, on one row."""
    sale, negative, product = F.col("is_sale_line"), F.col("is_negative_line"), F.col("is_product_like_code")
    anonymous = F.col("customer_id").isNull()
    sums = analysis.agg(
        _total(sale).alias("gross_sales"),
        _total(negative, sign=-1).alias("negative_value"),
        _total(F.col("unit_price") > 0).alias("net_transaction_value"),
        _total(negative & product, sign=-1).alias("product_like_negative_value"),
        _total(sale & product).alias("product_like_gross_sales"),
        _total(sale & anonymous).alias("anonymous_sales"),
        F.count_if(anonymous).alias("missing_customer_rows"),
        F.count("*").alias("row_count"),
    )
    c = F.col
    return sums.withColumns(
        {
            "negative_value_rate": share(c("negative_value"), c("gross_sales")),
            "product_like_return_rate": share(c("product_like_negative_value"), c("product_like_gross_sales")),
            "non_product_negative_share": share(
                c("negative_value") - c("product_like_negative_value"), c("negative_value")
            ),
            "missing_customer_share": share(c("missing_customer_rows"), c("row_count")),
            "anonymous_sales_share": share(c("anonymous_sales"), c("gross_sales")),
        }
    )


def overview(analysis: DataFrame) -> DataFrame:
    """Date range, rows and distinct counts on one row.

    Invoices are counted over all lines; sale invoices, stock codes, customers
    and countries over sales only. Each column has a grouping of its own: counted
    beside each other, every line would be expanded into one row for each count.
    """
    def distinct(column: str) -> DataFrame:
        """The values of a column, and whether they occur in sales."""
        return analysis.filter(F.col(column).isNotNull()).groupBy(column).agg(F.max("is_sale_line").alias("in_sales"))

    def distinct_in_sales(column: str) -> Column:
        return distinct(column).agg(F.count_if("in_sales")).scalar()

    sums = analysis.agg(
        F.min("invoice_date").cast("date").alias("first_date"),
        F.max("invoice_date").cast("date").alias("last_date"),
        F.count("*").alias("row_count"),
        _total(F.col("is_sale_line")).alias("gross_sales"),
        _total(F.col("is_negative_line"), sign=-1).alias("negative_value"),
        _total(F.col("unit_price") > 0).alias("net_transaction_value"),
    )
    invoices = distinct("invoice").agg(F.struct(F.count("*").alias("n"), F.count_if("in_sales").alias("in_sales"))).scalar()
    return sums.select(
        "first_date",
        "last_date",
        "row_count",
        invoices["n"].alias("invoices"),
        invoices["in_sales"].alias("sale_invoices"),
        distinct_in_sales("stock_code").alias("stock_codes"),
        distinct_in_sales("customer_id").alias("identified_customers"),
        distinct_in_sales("country").alias("countries"),
        "gross_sales",
        "negative_value",
        "net_transaction_value",
    )


def quality_scorecard(ledger: DataFrame) -> DataFrame:
    """Each issue with its row count and share, in long form.

    One aggregate over the row ledger serves all eight. The overlap is a share
    of all extract rows, repeats a share of the rows left after it, the rest a
    share of the analysed rows. The names of the issues are fixed values.
    """
    line = with_line_flags(ledger)
    kept = F.col("kept_rows") > 0
    below = retail.is_true(F.col("quantity") < 0)
    flags = {
        "Missing customer ID": F.col("customer_id").isNull(),
        "Missing description": F.col("description").isNull(),
        "Zero unit price": F.col("unit_price") == 0,
        "Negative unit price": F.col("unit_price") < 0,
        "Negative quantity": below,
        "Negative quantity without C-prefixed invoice": below & ~F.col("is_cancel_invoice"),
    }
    sums = line.agg(
        F.sum(F.col("older_rows") + F.col("newer_rows")).alias("all_rows"),
        F.sum("kept_rows").alias("kept_rows"),
        F.count_if(kept).alias("final_rows"),
        F.sum(F.least("older_overlap", "newer_overlap")).alias("overlap_rows"),
        *[F.count_if(kept & flag).alias(issue) for issue, flag in flags.items()],
    )
    issues = {
        "Cross-sheet date overlap": (F.col("overlap_rows"), F.col("all_rows")),
        "Remaining exact duplicate rows": (F.col("kept_rows") - F.col("final_rows"), F.col("kept_rows")),
        **{issue: (F.col(issue), F.col("final_rows")) for issue in flags},
    }
    rows = [
        F.struct(F.lit(issue).alias("issue"), n.cast("bigint").alias("row_count"), share(n, of).alias("row_share"))
        for issue, (n, of) in issues.items()
    ]
    return sums.select(F.inline(F.array(*rows)))
