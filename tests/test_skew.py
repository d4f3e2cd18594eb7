"""One key holds a third of the rows: results stay whole and the work is split."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import gold, upsert, versions
from tillflow.operators.retail import extracts, lines, products
from tillflow.sources import tables

ROWS = 60_000


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tight(spark):
    """No broadcast, and thresholds small enough to matter on test data."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions=8,
    )


def hot(key: str):
    """Every third row carries the hot key."""
    return F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit(key), (F.col("id") % 997).cast("string")))


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("O"), F.col("id")).alias("order_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("order_date"),
        F.lit("C").alias("customer_id"),
        hot("P").alias("product_id"),
        (F.col("id") % 7).cast("int").alias("quantity"),
        F.lit("2.50").cast("decimal(12,2)").alias("unit_price"),
        F.lit("East").alias("region"),
        F.lit(False).alias("has_schema_drift"),
        F.lit("orders_2024-01-01.csv").alias("_source_file"),
        F.lit("2024-01-01").cast("date").alias("_source_batch_date"),
        F.lit("2024-01-05").cast("timestamp").alias("_ingested_at"),
    )


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_in_the_reference_join(spark, orders):
    reference = spark.range(0, 997, 1, 4).select(
        F.concat(F.lit("P"), F.col("id")).alias("product_id"), (F.col("id") % 5).cast("string").alias("category")
    ).unionByName(spark.createDataFrame([("hot", "Hot")], "product_id STRING, category STRING"))
    facts = versions.with_line_facts(orders)
    broadcast = sorted(map(tuple, gold.daily_sales(facts, reference).collect()))
    with tight(spark):
        cells = gold.daily_sales(facts, reference)
        text = final_plan(cells)
        assert sorted(map(tuple, cells.collect())) == broadcast
    assert "skew=true" in text and sum(row[4] for row in broadcast) == ROWS


def test_hot_order_reaches_its_reducer_as_one_row_per_task(spark, orders):
    numbered = orders.withColumn("id", F.expr("CAST(substring(order_id, 2) AS BIGINT)"))
    resent = numbered.withColumn("order_id", hot("O")).drop("id")
    newest = versions.latest_version(resent)
    text = newest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = text[text.index("Exchange hashpartitioning(order_id"):]
    assert "row_number(), 1, Partial" in before_shuffle
    found = newest.filter("order_id = 'hot'").collect()
    assert len(found) == 1 and newest.count() == 998
    best = versions.with_record_hash(resent.filter("order_id = 'hot'")).agg(F.max("_record_hash")).first()[0]
    assert found[0]._record_hash == best


def test_hot_reject_is_split_in_the_quarantine_join(spark):
    source = spark.range(0, ROWS, 1, 8).select(hot("a").alias("a"), F.lit(None).cast("string").alias("b"))
    held = source.filter("a <> 'hot'").distinct()
    with tight(spark):
        new = upsert.insert_new(held, source, ["a", "b"])
        assert "skew=true" in final_plan(new)
        assert new.count() == ROWS // 3 and new.filter("a <> 'hot'").isEmpty()


def test_hot_date_slice_is_written_by_several_tasks(spark, orders, root):
    table = tables.SlicedTable(f"{root}/s", schemas.SILVER_ORDERS, "_slice")
    rows = versions.latest_version(orders).withColumn(
        "_slice", F.when(F.hash("order_id") % 3 == 0, F.lit("2024-02-01").cast("date")).otherwise(F.col("order_date")))
    slices = rows.select("_slice").distinct()
    with tight(spark), settings(spark, spark__sql__adaptive__coalescePartitions__enabled="true"):
        table.stage(rows, "w")
        table.publish(spark, "w", slices)
    assert len(list(Path(root, "s", "data", "_folder=w", "_slice=2024-02-01").glob("*.parquet"))) > 3
    assert table.read(spark).count() == ROWS
    assert table.read(spark).select("_slice").distinct().count() == 6


def test_hot_line_and_hot_code_fold_before_they_move(spark):
    base = spark.range(0, ROWS, 1, 8).select(
        F.lit("1").alias("invoice"),
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 50).cast("string")).alias("stock_code"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("d"), F.col("id") % 100)).alias("description"),
        F.lit(1).alias("quantity"),
        F.lit("2010-01-01").cast("timestamp").alias("invoice_date"),
        F.lit("1").cast("decimal(12,4)").alias("unit_price"),
        F.lit(1).cast("bigint").alias("customer_id"),
        F.lit("x").alias("country"),
        F.lit("a").alias("source_sheet"),
    )
    later = base.withColumn("invoice_date", F.lit("2010-01-02").cast("timestamp"))
    pair = extracts.pair_extracts([base.unionByName(later), later.withColumn("source_sheet", F.lit("b"))])
    ledger = extracts.row_ledger(pair)
    check = extracts.overlap_check(ledger).first()
    assert (check.identical_rows, check.is_exact_copy) == (ROWS, True)
    copies = ledger.filter("description = 'same' AND newer_rows > 0").first()
    assert (copies.older_overlap, copies.newer_overlap) == (ROWS // 3, ROWS // 3)
    modes = products.description_mode(lines.with_line_flags(pair.newer)).filter("stock_code = '1'").first()
    assert (modes.description, modes.line_count) == ("same", ROWS // 3)
