"""Declared table schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


# Fixed values from here on: names, types and keys of the table contracts.
# The order file contract: every field arrives, and is kept, as text.
ORDER_FIELDS = ["order_id", "order_date", "customer_id", "product_id", "quantity", "unit_price", "region"]
ORDER_FILE = _struct(**dict.fromkeys(ORDER_FIELDS, "string"))

BRONZE_ORDERS = _struct(
    **dict.fromkeys(ORDER_FIELDS, "string"), _rescued_data="string", _source_file="string", _ingested_at="timestamp"
)

PRODUCT_FIELDS = ["product_id", "product_name", "category", "list_price"]
BRONZE_PRODUCTS = _struct(**dict.fromkeys(PRODUCT_FIELDS, "string"), _source_file="string", _ingested_at="timestamp")

# `_record_hash` is kept so that two versions that tie on file and ingest time
# resolve the same way whether they meet in one micro-batch or in two.
SILVER_ORDERS = _struct(
    order_id="string",
    order_date="date",
    customer_id="string",
    product_id="string",
    quantity="integer",
    unit_price="decimal(12,2)",
    region="string",
    line_revenue="decimal(14,2)",
    is_return="boolean",
    is_zero_quantity="boolean",
    has_schema_drift="boolean",
    _source_file="string",
    _source_batch_date="date",
    _ingested_at="timestamp",
    _record_hash="string",
)

# Null-safe key of a rejected row: the same text from the same file is one reject.
QUARANTINE_KEY = [
    "_source_file", "order_id", "order_date_raw", "customer_id", "product_id",
    "quantity_raw", "unit_price_raw", "region_raw", "reject_reason",
]
QUARANTINE = _struct(
    order_id="string",
    order_date_raw="string",
    customer_id="string",
    product_id="string",
    quantity_raw="string",
    unit_price_raw="string",
    region_raw="string",
    reject_reason="string",
    _source_file="string",
    _ingested_at="timestamp",
    _quarantined_at="timestamp",
)
QUARANTINE_PARTITION = "_batch_date"

SILVER_PRODUCTS = _struct(
    product_id="string", product_name="string", category="string", list_price="decimal(12,2)", _ingested_at="timestamp"
)

REFRESH_QUEUE = _struct(order_date="date", queued_at="timestamp")

GOLD_DAILY_SALES = _struct(
    order_date="date",
    category="string",
    region="string",
    net_revenue="decimal(18,2)",
    order_count="long",
    units_sold="long",
    aov="decimal(18,2)",
    _refreshed_at="timestamp",
)

# One version of an order that leaves Silver or enters it; `kind` says which, or asks for a date to be rebuilt.
RETRACTED, ADDED, REBUILD = "retract", "add", "rebuild"
ORDER_CHANGES = _struct(
    order_date="date",
    product_id="string",
    region="string",
    quantity="integer",
    line_revenue="decimal(14,2)",
    kind="string",
)
# Which slice an order id was loaded into; no slice for an id that was rejected.
ORDER_INDEX = _struct(order_id="string", _slice="date")

# By how much a Silver batch changes the numbers of distinct order ids, and its rejects without an id.
BALANCE_COUNTS = _struct(ids_in="long", ids_loaded="long", ids_quarantined="long", rows_without_id="long")
# What a Silver batch counts.
AUDIT_COUNTS = _struct(
    rows_in="long",
    rows_parsed="long",
    rows_valid="long",
    rows_loaded="long",
    rows_quarantined="long",
    net_revenue="decimal(18,2)",
    dates_affected="long",
    **{field.name: "long" for field in BALANCE_COUNTS},
)
RUN_AUDIT = _struct(
    run_id="string",
    run_ts="timestamp",
    stage="string",
    rows_in="long",
    rows_loaded="long",
    rows_quarantined="long",
    net_revenue="decimal(18,2)",
    notes="string",
    rows_parsed="long",
    rows_valid="long",
    dates_affected="long",
    dates_queued="long",
    batch="string",
    **{field.name: "long" for field in BALANCE_COUNTS},
)

# Retail extract: source header -> column name.
EXTRACT_HEADERS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
EXTRACT_COLUMNS = list(EXTRACT_HEADERS.values())

# Four decimals, because a price of 0.001 must stay above zero: rounding it away
# would move the line out of the sales population.
RETAIL_PRICE = "decimal(12,4)"
RETAIL_MONEY = "decimal(22,4)"
