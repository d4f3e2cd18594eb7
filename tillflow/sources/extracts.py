"""Retail extracts: one frame per exported sheet, under common names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import retail


def standardise(raw: DataFrame, sheet: str) -> DataFrame:
    """Check the required headers, rename, trim, and read the typed columns."""
    missing = set(schemas.EXTRACT_HEADERS) - set(raw.columns)
    if missing:
        raise ValueError(f"extract '{sheet}' is missing columns: {sorted(missing)}")
    # A fraction of a piece is no quantity this ledger can hold; leaving it out would lose a sale.
    fractions = raw.agg(F.count_if(retail.is_fraction(F.col("Quantity")))).first()[0]
    if fractions:
        raise ValueError(f"extract '{sheet}' has {fractions} rows with a fractional quantity")
    named = raw.select(*[F.col(f"`{header}`").alias(name) for header, name in schemas.EXTRACT_HEADERS.items()])
    typed = {
        "quantity": retail.whole_number(F.col("quantity"), "int"),
        "invoice_date": retail.moment(F.col("invoice_date")),
        "unit_price": retail.number(F.col("unit_price"), schemas.RETAIL_PRICE),
        "customer_id": retail.whole_number(F.col("customer_id"), "bigint"),
    }
    text = {
        name: retail.clean_text(F.col(name).cast("string")) for name in schemas.EXTRACT_COLUMNS if name not in typed
    }
    return named.withColumns({**text, **typed, "source_sheet": F.lit(sheet)})


def read_extracts(spark: SparkSession, paths: dict[str, str], multi_line: bool = False) -> list[DataFrame]:
    """One standardised frame per sheet name and exported CSV.

    `multi_line` reads line breaks inside quoted text, at the price of one task
    per file.
    """
    reader = spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
    return [standardise(reader.csv(path), sheet) for sheet, path in paths.items()]
