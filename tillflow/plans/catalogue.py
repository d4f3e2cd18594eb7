"""The registered queries: every operator over whole star-schema tables.

Each callable takes (spark, sf_dir) and returns a frame. Columns that hold clock
time or a generated file name are left out, since no second run repeats them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import (
    classify, gold, products, profile, reconcile, refresh, snapshot, upsert, validate, versions,
)
from tillflow.operators.retail import countries, customers, extracts, negatives, quality, sales
from tillflow.operators.retail import products as retail_products
from tillflow.plans import pipeline, report, views
from tillflow.sources import scratch, tables
from tillflow.streaming.silver import run_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The season and months the report queries ask for.
REPORT_YEARS = [1996, 1997, 1998, 1999, 2000]
REPORT_MONTHS = [date(1998, 11, 1), date(1999, 11, 1)]
REPORT_COUNTRY = "NATION_7"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.with_line_facts(views.sales_lines(spark, sf_dir))


def _held_and_incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return views.landed(spark, sf_dir, "held_orders"), views.landed(spark, sf_dir, "incoming_orders")


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(views.landed(spark, sf_dir, "bronze_orders"))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.landed(spark, sf_dir, "silver_orders")


def _cleaned(spark: SparkSession, sf_dir: str) -> report.Cleaned:
    return report.Cleaned(views.retail_ledger(spark, sf_dir))


def _analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).analysis


# --- parsing, classification, versions ------------------------------------


@query
def parse_orders(spark, sf_dir):
    return _messy(spark, sf_dir).drop("_ingested_at")


@query
def reject_reasons(spark, sf_dir):
    return profile.reject_reasons(classify.rejected_rows(_messy(spark, sf_dir)))


@query
def quarantine_rows(spark, sf_dir):
    return classify.rejected_rows(_messy(spark, sf_dir)).drop("_ingested_at")


@query
def latest_version(spark, sf_dir):
    return versions.latest_version(views.sales_lines(spark, sf_dir)).drop("_ingested_at")


# --- upserts and the refresh queue ----------------------------------------


@query
def upsert_orders(spark, sf_dir):
    held, incoming = _held_and_incoming(spark, sf_dir)
    return upsert.upsert_orders(held, incoming).drop("_ingested_at")


@query
def quarantine_merge(spark, sf_dir):
    rejected = classify.rejected_rows(_messy(spark, sf_dir)).drop("_ingested_at")
    held = rejected.filter(F.col("reject_reason") == "unparseable_order_date")
    return held.unionByName(upsert.insert_new(held, rejected, schemas.QUARANTINE_KEY))


def _queue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date").agg(F.max("_source_batch_date").alias("queued_at"))


def _pending(queue: tables.RefreshQueue, spark: SparkSession) -> DataFrame:
    return queue.pending(spark).withColumn("queued_at", F.col("queued_at").cast("date"))


@query
def queue_upsert(spark, sf_dir):
    """Dates queued twice, under stamps of their own: each once, with the later one."""
    typed, queue = views.sales_lines(spark, sf_dir), tables.RefreshQueue(scratch.new_dir(spark, "queue"))
    for part in ("quantity >= 0", "quantity < 0"):
        queue.add(_queue(typed.filter(part)))
    return _pending(queue, spark)


@query
def queue_clear(spark, sf_dir):
    """Entries that were worked off go, by date and stamp, also when the log is compacted in between."""
    typed, queue = views.sales_lines(spark, sf_dir), tables.RefreshQueue(scratch.new_dir(spark, "queue"))
    queue.add(_queue(typed))
    queue.compact(spark)
    queue.clear(_queue(typed.filter("quantity >= 0")))
    return _pending(queue, spark)


@query
def affected_dates(spark, sf_dir):
    return refresh.affected_dates(*_held_and_incoming(spark, sf_dir))


# --- products --------------------------------------------------------------


@query
def conform_products(spark, sf_dir):
    return products.conform_products(views.messy_products(spark, sf_dir))


@query
def changed_products(spark, sf_dir):
    existing, incoming = views.revised_products(spark, sf_dir)
    return refresh.changed_products(incoming, existing)


@query
def product_affected_dates(spark, sf_dir):
    return refresh.product_affected_dates(views.sales_lines(spark, sf_dir), changed_products(spark, sf_dir))


# --- Gold ------------------------------------------------------------------


@query
def gold_daily_sales(spark, sf_dir):
    return gold.daily_sales(_sales(spark, sf_dir), views.products(spark, sf_dir))


@query
def gold_report(spark, sf_dir):
    return gold.sales_report(gold.daily_sales(_silver(spark, sf_dir), views.products(spark, sf_dir)))


def _stored_gold(spark: SparkSession, sf_dir: str) -> pipeline.Layout:
    """Gold of the held orders, by the pipeline's own steps: stage, gate, publish, verify, clear."""
    layout = pipeline.Layout(scratch.new_dir(spark, "gold"), slice_unit="year")
    layout.products.replace(views.products(spark, sf_dir).withColumn("_ingested_at", F.current_timestamp()))
    _replace_orders(spark, layout, views.landed(spark, sf_dir, "held_orders"))
    layout.queue.add(layout.orders.read(spark).select("order_date"))
    pipeline.refresh_gold(spark, layout, "query")
    return layout


def _replace_orders(spark: SparkSession, layout: pipeline.Layout, orders: DataFrame) -> None:
    folder = uuid.uuid4().hex
    layout.orders.stage(layout.silver.with_slice(orders), folder)
    layout.orders.publish(spark, folder, layout.orders.staged(spark, folder).select("_slice").distinct())


@query
def gold_pipeline(spark, sf_dir):
    return pipeline.read_gold(spark, _stored_gold(spark, sf_dir)).drop("_refreshed_at")


@query
def incremental_gold(spark, sf_dir):
    """Stored Gold, whose cells are moved by the changes that a batch makes; the oracle recomputes everything."""
    layout = _stored_gold(spark, sf_dir)
    held, incoming = _held_and_incoming(spark, sf_dir)
    layout.changes.put(upsert.net_changes(held, incoming), "incoming")
    layout.queue.add(refresh.affected_dates(held, incoming))
    _replace_orders(spark, layout, upsert.upsert_orders(held, incoming))
    pipeline.refresh_gold(spark, layout, "query")
    return pipeline.read_gold(spark, layout).drop("_refreshed_at")


@query
def order_changes(spark, sf_dir):
    held, incoming = _held_and_incoming(spark, sf_dir)
    return upsert.net_changes(held, incoming)


@query
def gold_changes(spark, sf_dir):
    """By how much a batch moves each Gold cell, from its changes alone; the oracle takes the difference of two whole Golds."""
    return gold.cell_changes(order_changes(spark, sf_dir), views.products(spark, sf_dir))


# --- streams ---------------------------------------------------------------


def _write_order_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Messy orders as CSV files with a header; files of drifted rows have a further field and another column order."""
    raw = views.landed(spark, sf_dir, "bronze_orders")
    writer = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    plain = raw.filter(F.col("_rescued_data").isNull()).select(*schemas.ORDER_FIELDS)
    drifted = raw.filter(F.col("_rescued_data").isNotNull()).select("_rescued_data", *reversed(schemas.ORDER_FIELDS))
    plain.write.options(**writer).csv(f"{folder}/plain")
    drifted.write.options(**writer).csv(f"{folder}/drifted")


@query
def stream_ingest_counts(spark, sf_dir):
    """Order files of two column orders to Bronze twice; the second run finds nothing new."""
    folder = scratch.new_dir(spark, "ingest")
    _write_order_files(spark, sf_dir, f"{folder}/inbox")
    layout = pipeline.Layout(f"{folder}/tables")
    for _ in range(2):
        pipeline.ingest_orders(spark, layout, f"{folder}/inbox/*", pattern="*.csv")
    bronze = pipeline.read_bronze(spark, layout)
    counts = bronze.agg(F.count("*").alias("rows_landed"), F.count("_rescued_data").alias("rows_with_schema_drift"))
    return counts.select("*", *profile.distinct_counts(bronze, schemas.ORDER_FIELDS))


@query
def stream_silver(spark, sf_dir):
    """Bronze to Silver in several micro-batches, then the same rows once more."""
    layout = pipeline.Layout(scratch.new_dir(spark, "silver"), slice_unit="year")
    bronze = views.landed_path(spark, sf_dir, "bronze_orders")
    half = -(-sum(n.startswith("part-") for n in tables.child_names(spark, bronze)) // 2)
    for rebuild in (False, True):
        run_silver(
            spark, bronze, layout.silver, layout.checkpoint("silver"), "query",
            rebuild=rebuild, max_files_per_trigger=None if rebuild else half,
        )
    return layout.orders.read(spark).drop("_slice", "_ingested_at")


# --- checks, profiles, balances --------------------------------------------


@query
def contract_violations(spark, sf_dir):
    return validate.contract_violations(_messy(spark, sf_dir), validate.order_rules())


@query
def gate_stats(spark, sf_dir):
    return validate.order_stats(_sales(spark, sf_dir))


@query
def cell_stats(spark, sf_dir):
    return validate.cell_stats(gold_daily_sales(spark, sf_dir))


@query
def landing_profile(spark, sf_dir):
    return profile.landing_profile(views.landed(spark, sf_dir, "bronze_orders"))


@query
def bronze_summary(spark, sf_dir):
    summary = profile.bronze_summary(views.landed(spark, sf_dir, "bronze_orders"))
    return summary.withColumns(
        {name: F.col(name).cast("date") for name in ("first_ingested_at", "last_ingested_at")}
    )


@query
def version_counts(spark, sf_dir):
    return profile.version_counts(views.landed(spark, sf_dir, "bronze_orders"))


@query
def rows_per_date(spark, sf_dir):
    return profile.rows_per_date(_silver(spark, sf_dir))


@query
def restatement_check(spark, sf_dir):
    typed = views.sales_lines(spark, sf_dir)
    return profile.restatement_check(versions.latest_version(typed), profile.version_counts(typed))


@query
def table_counts(spark, sf_dir):
    rejected = classify.rejected_rows(_messy(spark, sf_dir))
    silver = _silver(spark, sf_dir)
    return profile.table_counts(
        {
            "bronze.orders_raw": views.landed(spark, sf_dir, "bronze_orders"),
            "silver.orders": silver,
            "quarantine": rejected,
            "gold_refresh_queue": silver.select("order_date").distinct(),
        }
    )


@query
def row_balance(spark, sf_dir):
    return reconcile.row_balance(
        views.landed(spark, sf_dir, "bronze_orders"),
        _silver(spark, sf_dir),
        classify.rejected_rows(_messy(spark, sf_dir)),
    )


@query
def pipeline_totals(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    return reconcile.pipeline_totals(
        views.landed(spark, sf_dir, "bronze_orders"),
        silver,
        classify.rejected_rows(_messy(spark, sf_dir)),
        gold.daily_sales(silver, views.products(spark, sf_dir)),
    )


@query
def tie_out(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    cells = gold.daily_sales(silver, views.products(spark, sf_dir))
    return reconcile.tie_out(silver, cells, silver.select("order_date"))


@query
def run_audit(spark, sf_dir):
    return reconcile.audit_row("query", "gold", pipeline_totals(spark, sf_dir), "totals of one run").drop("run_ts")


def _gold_before_and_after(spark, sf_dir):
    held, incoming = _held_and_incoming(spark, sf_dir)
    reference = views.products(spark, sf_dir)
    return gold.daily_sales(held, reference), gold.daily_sales(upsert.upsert_orders(held, incoming), reference)


@query
def snapshot_diff(spark, sf_dir):
    return snapshot.snapshot_diff(*_gold_before_and_after(spark, sf_dir))


@query
def snapshot_totals(spark, sf_dir):
    return snapshot.snapshot_totals(*_gold_before_and_after(spark, sf_dir), "net_revenue")


# --- retail extracts ---------------------------------------------------------


def _day(frame: DataFrame, column: str = "invoice_date") -> DataFrame:
    return frame.withColumn(column, F.col(column).cast("date"))


@query
def extract_summary(spark, sf_dir):
    summary = extracts.extract_summary(views.retail_extracts(spark, sf_dir))
    return _day(_day(summary, "min_date"), "max_date")


@query
def overlap_check(spark, sf_dir):
    return extracts.overlap_check(_cleaned(spark, sf_dir).ledger)


@query
def overlap_resolved(spark, sf_dir):
    return _day(extracts.resolve_overlap(extracts.pair_extracts(views.retail_extracts(spark, sf_dir))))


@query
def cleaning_audit(spark, sf_dir):
    return extracts.cleaning_audit(_cleaned(spark, sf_dir).ledger)


@query
def overlap_impact(spark, sf_dir):
    return extracts.overlap_impact(_cleaned(spark, sf_dir).ledger)


@query
def line_flags(spark, sf_dir):
    return _day(_analysis(spark, sf_dir)).withColumn("line_value", F.col("line_value").cast(schemas.RETAIL_MONEY))


# --- retail metrics ----------------------------------------------------------


@query
def monthly_sales(spark, sf_dir):
    return sales.monthly_sales(_analysis(spark, sf_dir))


@query
def selected_months(spark, sf_dir):
    return sales.selected_months(monthly_sales(spark, sf_dir), REPORT_MONTHS)


@query
def peak_months(spark, sf_dir):
    analysis = _analysis(spark, sf_dir)
    data_end = analysis.agg(F.max("invoice_date").cast("date")).scalar()
    return sales.peak_months(sales.monthly_sales(analysis), data_end)


@query
def seasonality_share(spark, sf_dir):
    return sales.seasonality_share(monthly_sales(spark, sf_dir), REPORT_YEARS)


@query
def customer_summary(spark, sf_dir):
    return customers.customer_summary(_analysis(spark, sf_dir))


@query
def customer_concentration(spark, sf_dir):
    return customers.customer_concentration(customer_summary(spark, sf_dir))


@query
def repeat_purchase(spark, sf_dir):
    return customers.repeat_purchase(customer_summary(spark, sf_dir))


@query
def country_summary(spark, sf_dir):
    return countries.country_summary(_analysis(spark, sf_dir))


@query
def top_countries(spark, sf_dir):
    return countries.top_countries(country_summary(spark, sf_dir))


@query
def country_share(spark, sf_dir):
    return countries.share_of_country(country_summary(spark, sf_dir), REPORT_COUNTRY)


@query
def product_summary(spark, sf_dir):
    return retail_products.product_summary(_analysis(spark, sf_dir))


@query
def product_description_mode(spark, sf_dir):
    return retail_products.description_mode(_analysis(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return retail_products.top_products(_analysis(spark, sf_dir))


@query
def negative_breakdown(spark, sf_dir):
    return negatives.negative_breakdown(_analysis(spark, sf_dir))


@query
def top_negative_lines(spark, sf_dir):
    top = negatives.top_negative_lines(_analysis(spark, sf_dir))
    return _day(top).withColumn("negative_value", F.col("negative_value").cast(schemas.RETAIL_MONEY))


@query
def extreme_lines(spark, sf_dir):
    top = negatives.extreme_lines(_analysis(spark, sf_dir))
    return _day(top).withColumn("line_value", F.col("line_value").cast(schemas.RETAIL_MONEY))


@query
def headline_metrics(spark, sf_dir):
    return quality.headline_metrics(_analysis(spark, sf_dir))


@query
def overview(spark, sf_dir):
    return quality.overview(_analysis(spark, sf_dir))


@query
def quality_scorecard(spark, sf_dir):
    return quality.quality_scorecard(_cleaned(spark, sf_dir).ledger)
