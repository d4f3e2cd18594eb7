"""Comparing two states of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows held in different numbers, with both numbers.

    Counting copies per row compares the two as multisets in one grouping, with
    map-side sums, and never writes a repeated row out more than once.
    """
    columns = before.columns
    def tagged(frame: DataFrame, in_before: int) -> DataFrame:
        return frame.select(
            *columns,
            F.lit(in_before).cast("bigint").alias("copies_before"),
            F.lit(1 - in_before).cast("bigint").alias("copies_after"),
        )

    return (
        tagged(before, 1)
        .unionByName(tagged(after, 0))
        .groupBy(*columns)
        .agg(F.sum("copies_before").alias("copies_before"), F.sum("copies_after").alias("copies_after"))
        .filter(F.col("copies_before") != F.col("copies_after"))
    )


def snapshot_totals(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Row count and total of one column, before and after."""
    def side(name: str, frame: DataFrame) -> DataFrame:
        return frame.agg(
            F.lit(name).alias("state"),
            F.count("*").alias("row_count"),
            F.sum(column).cast("decimal(18,2)").alias("total"),
        )

    return side("before", before).unionByName(side("after", after))
