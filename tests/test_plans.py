"""The physical plans that scale rests on."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import samples
from tillflow.operators import gold, versions
from tillflow.operators.retail import countries, extracts, lines, negatives
from tillflow.plans import pipeline, report, views
from tillflow.plans.catalogue import QUERIES
from tillflow.plans.pipeline import Layout
from tillflow.sources import tables

SF_DIR = "/root/testdata/sf0.001"


def plan(frame, final: bool = False) -> str:
    if final:
        frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_latest_version_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(versions.latest_version(views.sales_lines(spark, SF_DIR)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_no_query_multiplies_tables(spark):
    for name in ("gold_daily_sales", "incremental_gold", "country_summary", "top_products", "overlap_check", "row_balance"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scans_read_only_the_columns_a_query_needs(spark):
    text = plan(QUERIES["gold_daily_sales"](spark, SF_DIR))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "l_discount" not in scan and "l_tax" not in scan


def test_rebuild_reads_only_the_slices_of_its_dates(spark, root):
    from pathlib import Path

    layout = Layout(f"{root}/t")
    for day in samples.DAYS:
        samples.drop_file(Path(root) / "inbox", day)
    pipeline.run(spark, layout, f"{root}/inbox", samples.product_file(Path(root)))
    for many in (1, 10, 1500):
        days = spark.range(many).select(F.date_add(F.lit(date(2024, 1, 2)), F.col("id").cast("int")).alias("order_date"))
        days.write.parquet(f"{root}/days-{many}")
        stored = spark.read.schema("order_date DATE").parquet(f"{root}/days-{many}")
        wanted = pipeline.read_orders_on(spark, layout, stored)
        assert "dynamicpruning" in plan(wanted)
        assert {row.order_date for row in wanted.select("order_date").collect()} <= {row[0] for row in stored.collect()}
    cells = plan(gold.daily_sales(wanted, layout.products.read(spark), unique_orders=True))
    assert cells.count("Exchange hashpartitioning") == 1


def files_read(frame) -> int:
    """Files that the scans of a frame open when it is collected."""
    frame.collect()
    count = 0

    def walk(node):
        nonlocal count
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            count += node.metrics().apply("numFiles").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return count


def test_a_small_batch_opens_only_slices_that_may_hold_its_orders(spark, root):
    """A thousand slices, three orders: their buckets of the index, and the three slices they were in."""
    from pyspark.sql import types as T

    from tillflow import schemas
    from tillflow.operators import refresh

    layout = Layout(root)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER_ORDERS if f.name not in ("order_id", "order_date")]
    rows = spark.range(1000).select(
        F.concat(F.lit("O"), "id").alias("order_id"), F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("order_date"), *empty
    )
    layout.orders.stage(layout.silver.with_slice(rows), "first")
    layout.orders.publish(spark, "first", layout.orders.staged(spark, "first").select("_slice").distinct())
    layout.index.add(layout.orders.read(spark).select("order_id", "_slice"), "first")
    batch = spark.createDataFrame([("O5",), ("O77",), ("O999",), ("new",)], "order_id STRING")
    batch.coalesce(1).write.parquet(f"{root}/batch")
    batch = spark.read.schema("order_id STRING").parquet(f"{root}/batch")
    found = layout.index.find(batch)
    assert files_read(found) <= 2 + 4
    assert sorted(r.order_id for r in found.collect()) == ["O5", "O77", "O999"]
    found.select("_slice").coalesce(1).write.parquet(f"{root}/slices")
    near = layout.orders.read(spark, spark.read.schema(T.StructType().add("_slice", "date")).parquet(f"{root}/slices"))
    held = refresh.held_versions(near.select(*schemas.SILVER_ORDERS.names), batch)
    assert held.count() == 3
    places = len(layout.orders._places.read(spark).inputFiles())
    assert files_read(held) <= 3 + 2 * places + 3


def test_gold_slices_are_few_files_in_date_order(spark, root):
    layout = pipeline.Layout(root, slice_unit="month")
    cells = spark.range(20_000).select(
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 365).cast("int")).alias("order_date"), F.lit("c").alias("category"),
        F.concat(F.lit("r"), F.col("id") % 50).alias("region"), F.lit(1).cast("decimal(18,2)").alias("net_revenue"),
        F.lit(1).cast("long").alias("order_count"), F.lit(1).cast("long").alias("units_sold"), F.lit(1).cast("decimal(18,2)").alias("aov"),
        F.current_timestamp().alias("_refreshed_at"),
    ).withColumn("_slice", layout.gold_slice())
    assert layout.gold.stage(cells, "f", n=F.count("*")) == {"n": 20_000}
    layout.gold.publish(spark, "f", cells.select("_slice").distinct())
    stored = layout.gold.read(spark)
    assert len(stored.inputFiles()) <= 12 + 8
    assert stored.count() == 20_000 and layout.gold.slice_totals(spark).agg(F.sum("orders")).first()[0] == 20_000


def test_writes_count_what_they_write(spark, root):
    frame = spark.range(100).repartition(5)
    assert tables.write_counted(frame, f"{root}/a", n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1)) == {"n": 100, "odd": 50}
    assert not any(tables.write_counted(frame.filter("id < 0"), f"{root}/b", n=F.count("*")).values())


def test_cleaning_costs_one_shuffle_and_the_total_reuses_it(spark):
    ledger = extracts.row_ledger(extracts.pair_extracts(views.retail_extracts(spark, SF_DIR)))
    assert plan(extracts.cleaning_audit(ledger)).count("Exchange hashpartitioning") == 1
    cleaned = report.Cleaned(views.retail_ledger(spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan(cleaned.analysis)
    analysis = lines.with_line_flags(extracts.distinct_lines(ledger))
    for frame in (countries.country_summary(analysis), negatives.negative_breakdown(analysis)):
        assert "ReusedExchange" in plan(frame, final=True)


@pytest.mark.parametrize("name", ["top_countries", "extreme_lines", "top_negative_lines"])
def test_top_rows_are_taken_without_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR).select(F.col("*")))


def test_overlap_bounds_reach_the_scan(spark):
    pair = extracts.pair_extracts(views.retail_extracts(spark, SF_DIR))
    text = plan(pair.older.filter(pair.older_kept()))
    assert "PushedFilters: [" in text and "LessThan(invoice_date" in text
