"""Parsing expressions against the listed cases, and Spark's results at the edges."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions import parsing


def evaluate(spark, expression, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "n INT, raw STRING")
    return [row[0] for row in frame.orderBy("n").select(expression(F.col("raw"))).collect()]


DATES = [
    ("2024-01-02", date(2024, 1, 2)), ("01/02/2024", date(2024, 1, 2)), ("1704153600", date(2024, 1, 2)),
    ("not-a-date", None), ("", None), (None, None), ("  2024-01-02 ", date(2024, 1, 2)),
    # Unpadded parts, impossible days and epochs of another length are not dates.
    ("1/2/2024", None), ("2024-1-2", None), ("2024-02-30", None), ("13/01/2024", None),
    ("170415360", None), ("99999999999999999999", None), ("2024-01-02T00:00:00", None),
    ("1704239999", date(2024, 1, 2)), ("1704240000", date(2024, 1, 3)), ("0000000000", date(1970, 1, 1)),
]

PRICES = [
    ("24.99", "24.99"), ("$1,099.00", "1099.00"), ("3.50", "3.50"), ("N/A", None), (None, None), ("", None),
    ("(5.00)", "5.00"), ("1e3", "13.00"), ("1.099,00", "1.10"), ("5-3", None), ("1.005", "1.01"),
    ("12345678901", None), ("-$4.10", "-4.10"),
]

REGIONS = [
    ("west", "West"), ("North", "North"), (None, "Unknown"), ("   ", "Unknown"),
    ("O'BRIEN", "O'brien"), ("NORTH-EAST", "North-east"), (" middle  east ", "Middle  East"), ("\twest", "\twest"),
]

QUANTITIES = [("1", 1), (" -2 ", -2), ("0", 0), ("2.0", None), ("", None), ("x", None), (None, None), ("99999999999", None)]


@pytest.mark.parametrize(
    ("expression", "cases"),
    [
        (parsing.order_date, DATES),
        (parsing.unit_price, [(raw, value and Decimal(value)) for raw, value in PRICES]),
        (parsing.region, REGIONS),
        (parsing.quantity, QUANTITIES),
        (parsing.category, [("electronics", "Electronics"), (" Home & office ", "Home & Office"), (None, None)]),
        (parsing.list_price, [("24.99", Decimal("24.99")), ("$5", None), ("n/a", None)]),
        (parsing.blank_to_null, [("  ", None), (" C1 ", "C1"), (None, None)]),
        (
            parsing.file_date,
            [("orders_2024-01-03.csv", date(2024, 1, 3)), ("orders.csv", None), ("orders_2024-13-40.csv", None), (None, None)],
        ),
    ],
    ids=["date", "price", "region", "quantity", "category", "list_price", "blank", "file_date"],
)
def test_expression(spark, expression, cases):
    assert evaluate(spark, expression, [raw for raw, _ in cases]) == [value for _, value in cases]


def test_epoch_date_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert evaluate(spark, parsing.order_date, ["1704153600"]) == [date(2024, 1, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_guards_let_every_parseable_text_through(spark):
    """The shape check before a parser must never turn away what the parser takes."""
    texts = ["2024-01-02", "0001-01-01", "9999-12-31", "+12024-01-02", "12024-01-02", "-2024-01-02", "01/02/+12024",
             "12/31/9999", "01/02/12024", "2024-01-02 ", "02/30/2024", "2024/01/02", "01-02-2024"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n INT, raw STRING").orderBy("n")
    plain = F.coalesce(*[F.try_to_date(F.trim("raw"), layout) for layout in parsing.DATE_LAYOUTS])
    rows = frame.select(plain.cast("string").alias("plain"), parsing.order_date(F.col("raw")).cast("string").alias("guarded")).collect()
    assert [row.plain for row in rows] == [row.guarded for row in rows]
