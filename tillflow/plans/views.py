"""Order, product and retail shapes derived from the star-schema tables.

Every view covers its whole tables. Moduli below only decide what a row looks
like (which date layout, which defect), never whether it is there.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import classify, versions
from tillflow.operators.retail import extracts
from tillflow.session import bound_tasks
from tillflow.sources import scratch, tables

# Star-schema dates lie before the ten-digit epochs; messy dates move past them.
SHIFT_DAYS = 3653
# The second extract starts before the first one ends.
FIRST_EXTRACT_END = "1999-07-01"
SECOND_EXTRACT_START = "1998-10-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_tasks(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.col(column) % n == rest


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the order, customer, nation and region they belong to.

    Orders meet their customers before they meet the lines, so lines move once at most, and
    as the few columns that are asked for.
    """
    owned = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return table(spark, sf_dir, "lineitem").join(owned, F.col("l_orderkey") == F.col("o_orderkey"))


def _order_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _signed_quantity() -> Column:
    quantity = F.col("l_quantity").cast("int")
    return F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity)


def _ship_date() -> Column:
    return F.col("l_shipdate").cast("date")


def _order_date() -> Column:
    """An order's lines fall on up to three dates, so a new version can move one."""
    return F.date_add(F.col("o_orderdate").cast("date"), (F.col("l_suppkey") % 3).cast("int"))


def _ingested_at() -> Column:
    hours = F.make_dt_interval(hours=(F.col("l_suppkey") % 3).cast("int"))
    return (F.col("l_shipdate") + hours).cast("timestamp")


def _product_id() -> Column:
    """Some lines name a product the reference does not hold."""
    unknown = (F.col("l_partkey") + F.col("l_suppkey")) % 10 == 0
    key = F.col("l_partkey").cast("string")
    return F.when(unknown, F.concat(F.lit("X"), key)).otherwise(key)


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order versions; ids repeat, as when orders are re-sent or restated."""
    return joined_lines(spark, sf_dir).select(
        _order_id().alias("order_id"),
        _order_date().alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _product_id().alias("product_id"),
        _signed_quantity().alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("r_name").alias("region"),
        (F.col("l_linenumber") == 7).alias("has_schema_drift"),
        F.concat(F.lit("orders_"), _ship_date().cast("string"), F.lit(".csv")).alias("_source_file"),
        _ship_date().alias("_source_batch_date"),
        _ingested_at().alias("_ingested_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
    )


def revised_products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The reference before and after a revision that adds, drops and alters products."""
    base = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
        "p_size",
    )
    existing = base.filter("p_size <= 45").drop("p_size")
    incoming = (
        base.filter("p_size >= 5")
        .withColumn("product_name", F.when(_every("p_size", 13), None).otherwise(F.col("product_name")))
        .withColumn("category", F.when(_every("p_size", 7), F.lit("REVISED")).otherwise(F.col("category")))
        .withColumn(
            "list_price",
            F.when(_every("p_size", 11), F.col("list_price") + 1).otherwise(F.col("list_price")).cast("decimal(12,2)"),
        )
        .drop("p_size")
    )
    return existing, incoming


def messy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference as untidy text: padded, oddly cased, sent twice, some without id."""
    part = table(spark, sf_dir, "part")
    key = F.concat(F.lit(" "), F.col("p_partkey").cast("string"))
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    first = part.select(
        key.alias("product_id"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("product_name"),
        F.concat(F.lit(" "), F.lower("p_type")).alias("category"),
        F.when(_every("p_size", 9), F.lit("n/a")).otherwise(price).alias("list_price"),
    )
    second = part.select(
        F.when(_every("p_size", 8), F.lit("  ")).otherwise(key).alias("product_id"),
        F.when(_every("p_size", 6), None).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("list_price"),
    )
    return first.unionByName(second)


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as raw text in Bronze shape, with every kind of defect."""
    shifted = F.date_add(_order_date(), SHIFT_DAYS)
    iso = shifted.cast("string")
    days = F.datediff(shifted, F.lit("1970-01-01").cast("date")).cast("bigint")
    epoch = (days * 86400 + F.col("l_suppkey")).cast("string")
    order_date = (
        F.when(_every("l_orderkey", 5, 1), F.date_format(shifted, "MM/dd/yyyy"))
        .when(_every("l_orderkey", 5, 2), epoch)
        .when(_every("l_orderkey", 5, 3) & _every("l_linenumber", 2), F.concat(F.lit("bad "), iso))
        .when(_every("l_orderkey", 5, 4), F.concat(F.lit("  "), iso, F.lit(" ")))
        .otherwise(iso)
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    unit_price = (
        F.when(_every("l_partkey", 17), None)
        .when(_every("l_partkey", 19), F.lit("N/A"))
        .when(_every("l_partkey", 31), F.concat(F.lit("-$"), price.cast("string")))
        .otherwise(F.concat(F.lit("$"), F.format_number(price, 2)))
    )
    quantity = (
        F.when(_every("l_partkey", 23), F.lit("2.0"))
        .when(_every("l_partkey", 29), F.lit(""))
        .otherwise(F.concat(F.lit(" "), _signed_quantity().cast("string")))
    )
    region = (
        F.when(_every("l_linenumber", 4, 1), F.lower("r_name"))
        .when(_every("l_linenumber", 4, 2), F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("r_name")))
    )
    order_id = (
        F.when(_every("l_suppkey", 50), F.lit("  "))
        .when(_every("l_suppkey", 3), F.concat(_order_id(), F.lit(" ")))
        .otherwise(_order_id())
    )
    source_file = F.when(_every("l_suppkey", 40, 1), F.lit("orders_resend.csv")).otherwise(
        F.concat(F.lit("orders_"), _ship_date().cast("string"), F.lit(".csv"))
    )
    columns = [
        order_id.alias("order_id"),
        order_date.alias("order_date"),
        F.when(_every("o_custkey", 4), F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        _product_id().alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        region.alias("region"),
        F.when(F.col("l_linenumber") == 7, F.lit("EXTRA")).alias("_rescued_data"),
        source_file.alias("_source_file"),
        _ingested_at().alias("_ingested_at"),
    ]
    return joined_lines(spark, sf_dir).select(*columns)


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail lines, some of them repeated."""
    key = F.col("l_partkey").cast("string")
    invoice = F.col("l_orderkey").cast("string")
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    prefix = F.when(_every("l_linenumber", 2), F.lit("c")).otherwise(F.lit("C"))
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast(schemas.RETAIL_PRICE)
    zero = F.lit(0).cast(schemas.RETAIL_PRICE)
    lines = joined_lines(spark, sf_dir).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.when(cancelled, F.concat(prefix, invoice)).otherwise(invoice).alias("invoice"),
        F.when(_every("l_partkey", 20), F.concat(F.lit("M"), key)).otherwise(key).alias("stock_code"),
        F.when(_every("l_partkey", 37), None)
        .when(F.col("l_linenumber") <= 3, F.upper("p_name"))
        .otherwise(F.col("p_name"))
        .alias("description"),
        F.when(_every("l_suppkey", 97), None).otherwise(_signed_quantity()).alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("invoice_date"),
        F.when(_every("l_suppkey", 25), zero)
        .when(_every("l_suppkey", 41), -price)
        .otherwise(price)
        .cast(schemas.RETAIL_PRICE)
        .alias("unit_price"),
        F.when(_every("o_custkey", 4), None).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when((F.col("n_nationkey") == 3) & (F.col("l_linenumber") == 6), None).otherwise(F.col("n_name")).alias("country"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("l_linenumber") == 7, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def held_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest deliveries, as orders held before a batch of returns arrives."""
    return versions.latest_version(sales_lines(spark, sf_dir).filter("quantity >= 0"))


def incoming_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest returns. Many of their order ids are held, with either side the later one."""
    return versions.latest_version(sales_lines(spark, sf_dir).filter("quantity < 0"))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest valid version of every messy order."""
    bronze = landed(spark, sf_dir, "bronze_orders")
    return versions.latest_version(classify.valid_rows(classify.classify(bronze)))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.row_ledger(extracts.pair_extracts(retail_extracts(spark, sf_dir)))


# Views that stand for stored tables: raw files, extracts, and the Silver layer
# that balances and reports read. Each is written once per session.
LANDINGS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_orders": messy_orders,
    "silver_orders": silver_orders,
    "held_orders": held_orders,
    "incoming_orders": incoming_orders,
    "retail_lines": retail_lines,
    "retail_ledger": _ledger,
}
# Views that are joined by a key over and over lie in buckets of it, so that those joins move nothing.
BUCKETED = {"held_orders": "order_id", "incoming_orders": "order_id"}
# What a stored view has to prove before anything reads it.
PROOFS = {"retail_ledger": extracts.require_exact_copy}
_LANDED: dict[tuple[str, str, str], str] = {}
_LANDING = RLock()


def landed_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a view of `LANDINGS` is stored, after storing it if need be."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _LANDING:
        if key not in _LANDED or not tables.is_complete(spark, _LANDED[key]):
            folder = scratch.new_dir(spark, name)
            frame = LANDINGS[name](bound_tasks(spark), sf_dir)
            if name in BUCKETED:
                tables.write_buckets(frame, folder, BUCKETED[name])
            else:
                frame.write.option("compression", tables.CODEC).parquet(folder)
            if name in PROOFS:
                PROOFS[name](spark.read.parquet(folder))
            _LANDED[key] = folder
    return _LANDED[key]


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    folder = landed_path(spark, sf_dir, name)
    return tables.read_buckets(bound_tasks(spark), folder) if name in BUCKETED else bound_tasks(spark).read.parquet(folder)


def retail_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the two extracts, stored once and proved when it is."""
    return landed(spark, sf_dir, "retail_ledger")


def retail_extracts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two extracts that overlap in time."""
    lines = landed(spark, sf_dir, "retail_lines")
    day = F.col("invoice_date").cast("date")
    first = lines.filter(day < F.lit(FIRST_EXTRACT_END).cast("date")).withColumn("source_sheet", F.lit("first"))
    second = lines.filter(day >= F.lit(SECOND_EXTRACT_START).cast("date")).withColumn("source_sheet", F.lit("second"))
    return [second, first]
