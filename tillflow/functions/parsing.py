"""Column expressions that turn raw order text into typed values.

Every expression yields null, never an error, for text it cannot read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts and the shape of their text, the characters a price may keep, and
# the label for a missing region or category.
DATE_LAYOUTS = {
    "yyyy-MM-dd": r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2}$",
    "MM/dd/yyyy": r"^[0-9]{2}/[0-9]{2}/[+-]?[0-9]{4,}$",
}
EPOCH_TEXT = "^[0-9]{10}$"
# Text that can be a whole number: one run of digits, no letters, no point.
WHOLE_TEXT = r"^[^\w.]*+[0-9]++[^\w.]*+$"
NOT_PRICE_CHARS = "[^0-9.-]"
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"
UNKNOWN = "Unknown"

SECONDS_PER_DAY = 86400


def blank_to_null(raw: Column) -> Column:
    trimmed = F.trim(raw)
    return F.nullif(trimmed, F.lit(""))


def order_date(raw: Column) -> Column:
    """ISO, then US month-first, then ten-digit epoch seconds read as UTC.

    Text is only handed to a parser whose layout it has: a failed parse costs an
    exception, many times the price of looking at the text first.
    """
    text = F.trim(raw)
    dated = [F.when(text.rlike(shape), F.try_to_date(text, layout)) for layout, shape in DATE_LAYOUTS.items()]
    # Whole days since 1970 give the UTC date under any session time zone.
    days = F.floor(text.try_cast("bigint") / SECONDS_PER_DAY).try_cast("int")
    epoch = F.when(text.rlike(EPOCH_TEXT), F.date_add(F.lit("1970-01-01").cast("date"), days))
    return F.coalesce(*dated, epoch)


def quantity(raw: Column) -> Column:
    """Whole numbers; text of another shape is not handed to the cast, which would pay an exception for it."""
    text = F.trim(raw)
    return F.when(text.rlike(WHOLE_TEXT), text.try_cast("int"))


def unit_price(raw: Column) -> Column:
    """Drop currency signs and separators, then read what is left as money."""
    return F.regexp_replace(F.trim(raw), NOT_PRICE_CHARS, "").try_cast("decimal(12,2)")


def list_price(raw: Column) -> Column:
    return raw.try_cast("decimal(12,2)")


def region(raw: Column) -> Column:
    return F.initcap(F.coalesce(blank_to_null(raw), F.lit(UNKNOWN)))


def category(raw: Column) -> Column:
    return F.initcap(F.trim(raw))


def file_date(file_name: Column) -> Column:
    """The drop date in a file name, null when the name carries none."""
    found = F.nullif(F.regexp_extract(file_name, FILE_DATE, 1), F.lit(""))
    return F.try_to_date(found, "yyyy-MM-dd")


def record_hash(*fields: Column) -> Column:
    """Content hash of a record, nulls read as empty text."""
    texts = [F.coalesce(field.cast("string"), F.lit("")) for field in fields]
    return F.sha2(F.concat_ws("||", *texts), 256)
