"""Contracts on write, and the checks around publishing Gold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

REQUIRED_ORDER_FIELDS = ["order_id", "order_date", "quantity", "unit_price", "region"]


class ValidationError(RuntimeError):
    """A contract or a publish check did not hold."""


def order_rules() -> dict[str, Column]:
    """The Silver contract: what must be true of every row."""
    rules = {f"{name}_not_null": F.col(name).isNotNull() for name in REQUIRED_ORDER_FIELDS}
    rules["unit_price_non_negative"] = F.col("unit_price") >= 0
    rules["region_present"] = F.col("region") != ""
    return rules


def product_rules() -> dict[str, Column]:
    return {"product_id_not_null": F.col("product_id").isNotNull()}


def gold_rules() -> dict[str, Column]:
    return {f"{name}_not_null": F.col(name).isNotNull() for name in ("order_date", "category", "region")}


def contract_violations(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: for each rule, how many rows do not satisfy it. Unknown is not satisfied."""
    return frame.agg(*[count.alias(name) for name, count in violation_counts(rules).items()])


def violation_counts(rules: dict[str, Column]) -> dict[str, Column]:
    """The rules as aggregates, to be observed while rows are written."""
    return {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()}


def refuse_violations(found: dict[str, int | None], table: str) -> None:
    broken = {name: n for name, n in found.items() if n}
    if broken:
        raise ValidationError(f"{table}: rows break the contract: {broken}")


def enforce_contract(frame: DataFrame, rules: dict[str, Column], table: str) -> None:
    refuse_violations(contract_violations(frame, rules).first().asDict(), table)


def order_stats(orders: DataFrame) -> DataFrame:
    """Revenue, rows, repeated order ids and rows with a required field missing."""
    missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in REQUIRED_ORDER_FIELDS])
    return orders.agg(
        F.coalesce(F.sum("line_revenue"), F.lit(0)).cast("decimal(18,2)").alias("net_revenue"),
        F.count("*").alias("row_count"),
        (F.count("*") - F.countDistinct("order_id")).alias("duplicate_order_ids"),
        F.count_if(missing).alias("invalid_contract_rows"),
    )


def cell_stats(gold: DataFrame) -> DataFrame:
    """Revenue and row count of a Gold candidate or of published slices."""
    return gold.agg(
        F.coalesce(F.sum("net_revenue"), F.lit(0)).cast("decimal(18,2)").alias("net_revenue"),
        F.count("*").alias("row_count"),
    )


def gate(orders: DataFrame, candidate: DataFrame) -> Row:
    """Checks before publishing; returns the candidate's stats."""
    silver, cells = order_stats(orders).first(), cell_stats(candidate).first()
    if silver.duplicate_order_ids:
        raise ValidationError(f"Silver repeats order ids in {silver.duplicate_order_ids} rows of the queued dates")
    if silver.invalid_contract_rows:
        raise ValidationError(f"Silver misses required fields in {silver.invalid_contract_rows} rows")
    if cells.net_revenue != silver.net_revenue:
        raise ValidationError(
            f"candidate revenue {cells.net_revenue} is not Silver revenue {silver.net_revenue}; nothing was published"
        )
    return cells


def ties_out(silver: Row, candidate: Row) -> bool:
    """Whether the totals that Silver keeps for its slices are those of a candidate for the same dates."""
    return silver.net_revenue == candidate.net_revenue and silver.orders == candidate.orders


def verify_published(published: DataFrame, expected: Row) -> None:
    """Check after publishing; the caller keeps its queue entries when this raises."""
    found = cell_stats(published).first()
    if found != expected:
        raise ValidationError(f"published {found.asDict()} is not the candidate {expected.asDict()}; queue kept")
