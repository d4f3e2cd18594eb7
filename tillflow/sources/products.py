"""The product reference file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas


def read_product_file(spark: SparkSession, path: str) -> DataFrame:
    """The exported reference as text, header names trimmed and lower-cased."""
    raw = spark.read.option("header", "true").csv(path)
    named = raw.toDF(*[name.strip().lower() for name in raw.columns])
    missing = set(schemas.PRODUCT_FIELDS) - set(named.columns)
    if missing:
        raise ValueError(f"product file lacks columns {sorted(missing)}")
    return named.select(
        *schemas.PRODUCT_FIELDS,
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )
