"""Column expressions for the retail extracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space that is stripped from extract text.
WHITESPACE = " \t\n\r\f\x0b "


def clean_text(raw: Column) -> Column:
    return F.trim(raw, F.lit(WHITESPACE))


def number(raw: Column, sql_type: str) -> Column:
    """Read a number; null when it is not one."""
    return clean_text(raw).try_cast(sql_type)


def whole_number(raw: Column, sql_type: str) -> Column:
    """Read a whole number written as `13085` or `13085.0`; null otherwise."""
    value = clean_text(raw).try_cast("decimal(28,6)")
    return F.when(value == F.floor(value), value.try_cast(sql_type))


def is_fraction(raw: Column) -> Column:
    """A number that is not whole."""
    value = number(raw, "decimal(28,6)")
    return is_true(value != F.floor(value))


def moment(raw: Column) -> Column:
    return F.try_to_timestamp(clean_text(raw))


def is_true(predicate: Column) -> Column:
    """A comparison with a missing value is false, not unknown."""
    return F.coalesce(predicate, F.lit(False))


def is_cancel_invoice(invoice: Column) -> Column:
    return is_true(F.upper(invoice).startswith("C"))


def is_product_like(stock_code: Column) -> Column:
    return is_true(stock_code.rlike("^[0-9]"))


def is_sale(quantity: Column, unit_price: Column, invoice: Column) -> Column:
    return is_true(quantity > 0) & is_true(unit_price > 0) & ~is_cancel_invoice(invoice)


def is_negative(quantity: Column, unit_price: Column) -> Column:
    return is_true(quantity < 0) & is_true(unit_price > 0)


def share(part: Column, whole: Column) -> Column:
    """A ratio at report precision; null when there is nothing to divide by."""
    return F.round(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), 6)


def average(total: Column, count: Column, sql_type: str) -> Column:
    """Money per item, rounded half up; null when there are no items."""
    return (total / F.nullif(count, F.lit(0).cast("bigint"))).cast(sql_type)
