"""Readers and tables."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import samples
from tillflow import schemas
from tillflow.operators import profile
from tillflow.plans import pipeline
from tillflow.plans.pipeline import Layout
from tillflow.sources import scratch, tables
from tillflow.sources.extracts import read_extracts
from tillflow.sources.orders import surplus_line
from tillflow.sources.products import read_product_file

GOOD = "O1,2024-01-01,C1,P1,1,2.00,East"


def test_only_overlong_lines_are_drift(spark, root):
    lines = {
        "exact": GOOD,
        "short": "short,2024-01-01,C1",
        "long": GOOD.replace("O1", "long") + ",X",
        "late": GOOD.replace("O1", "late") + ",,,X",
        "empty": GOOD.replace("O1", "empty") + ",,",
        "quoted": 'quoted,2024-01-01,C1,P1,1,"$1,000,000.00",East',
        "quoted_long": 'quoted_long,2024-01-01,C1,P1,1,"$1,000.00",East,"a,b"',
        "far": GOOD.replace("O1", "far") + "," * 60 + "X",
    }
    inbox = Path(root) / "inbox"
    samples.drop_file(inbox, "2024-01-01", "\n".join(lines.values()))
    (inbox / "other.csv").write_text("not,an,order,file\n")
    layout = Layout(f"{root}/t")
    pipeline.ingest_orders(spark, layout, str(inbox))
    bronze = pipeline.read_bronze(spark, layout)
    rescued = {r.order_id: r._rescued_data for r in bronze.filter("_rescued_data IS NOT NULL").collect()}
    assert rescued == {name: lines[name] for name in ("long", "late", "quoted_long", "far")}
    assert bronze.count() == len(lines)
    assert bronze.filter("order_id = 'quoted'").first().unit_price == "$1,000,000.00"
    assert bronze.filter("order_id = 'long'").first().region == "East"
    seen = profile.landing_profile(bronze).collect()
    assert [tuple(r) for r in seen] == [("orders_2024-01-01.csv", 8, 4, 1)]


def test_fields_land_by_header_name(spark, root):
    inbox, layout = Path(root) / "inbox", Layout(f"{root}/t")
    inbox.mkdir()
    files = {
        "moved": "region,order_id,order_date,product_id,customer_id,unit_price,quantity\nEast,moved,2024-01-01,P1,C1,2.00,1\n",
        "extra": "order_id,order_date,customer_id,coupon,product_id,quantity,unit_price,region\nextra,2024-01-01,C1,X9,P1,1,2.00,East\n"
                 "plain,2024-01-01,C1,,P1,1,2.00,East\n\n",
        "missing": "order_id,order_date,customer_id,product_id,quantity,region\nmissing,2024-01-01,C1,P1,1,East\n",
        "renamed": " ORDER_ID ,order_date,customer,product_id,quantity,unit_price,region\nrenamed,2024-01-01,C1,P1,1,2.00,East,more\n",
        "empty": "",
        "bare": "order_id,order_date,customer_id,product_id,quantity,unit_price,region\n",
    }
    for name, text in files.items():
        (inbox / f"orders_{name}.csv").write_text(text)
    pipeline.ingest_orders(spark, layout, str(inbox))
    found = {r.order_id: r for r in pipeline.read_bronze(spark, layout).collect()}
    assert set(found) == {"moved", "extra", "plain", "missing", "renamed"}
    for name in ("moved", "extra", "plain"):
        row = found[name]
        assert (row.order_date, row.customer_id, row.product_id, row.quantity, row.unit_price, row.region) == (
            "2024-01-01", "C1", "P1", "1", "2.00", "East")
    assert found["missing"].unit_price is None and found["renamed"].customer_id is None
    assert {n for n, r in found.items() if r._rescued_data} == {"extra", "renamed"}
    assert found["extra"]._rescued_data == "extra,2024-01-01,C1,X9,P1,1,2.00,East"


def test_each_file_is_read_once(spark, root):
    inbox, layout = Path(root) / "inbox", Layout(f"{root}/t")
    samples.drop_file(inbox, "2024-01-01")
    for _ in range(2):
        pipeline.ingest_orders(spark, layout, str(inbox))
    samples.drop_file(inbox, "2024-01-02")
    pipeline.ingest_orders(spark, layout, str(inbox))
    bronze = pipeline.read_bronze(spark, layout)
    assert bronze.count() == 24
    assert {f.dataType.simpleString() for f in bronze.schema if f.name in schemas.ORDER_FIELDS} == {"string"}
    assert profile.bronze_summary(bronze).first().source_files == 2


def test_product_headers_are_cleaned_and_required(spark, root):
    frame = read_product_file(spark, samples.product_file(Path(root)))
    assert frame.columns == schemas.BRONZE_PRODUCTS.names and frame.count() == 10
    assert frame.first()._source_file == "products.csv" and frame.first().list_price == "24.99"
    with pytest.raises(ValueError, match="category"):
        read_product_file(spark, samples.product_file(Path(root) / "x", "product_id,product_name,list_price\nP1,n,1"))


EXTRACT = """Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
 1 ,85048,"  LAMP, RED ",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom
2,M,,x,not a date,0.001,,\tFrance
C3,21,A,2.0,2009-12-02,n/a,13.5,EIRE
"""


def test_extract_columns_are_coerced(spark, root):
    path = Path(root) / "a.csv"
    path.write_text(EXTRACT)
    (frame,) = read_extracts(spark, {"Year 1": str(path)})
    rows = frame.orderBy("invoice").collect()
    assert frame.columns == [*schemas.EXTRACT_COLUMNS, "source_sheet"]
    one, two, three = rows
    assert (one.invoice, one.description, one.quantity, one.customer_id) == ("1", "LAMP, RED", 12, 13085)
    assert (one.unit_price, one.source_sheet) == (Decimal("6.9500"), "Year 1")
    assert (two.quantity, two.invoice_date, two.customer_id, two.description, two.country) == (None, None, None, None, "France")
    assert two.unit_price == Decimal("0.0010")
    assert (three.quantity, three.unit_price, three.customer_id) == (2, None, None)
    assert frame.filter("invoice = 'C3'").select(F.col("invoice_date").cast("string")).first()[0] == "2009-12-02 00:00:00"


def test_extract_without_a_required_column_is_refused(spark, root):
    path = Path(root) / "a.csv"
    path.write_text("Invoice,StockCode\n1,2\n")
    with pytest.raises(ValueError, match="Customer ID"):
        read_extracts(spark, {"Year 1": str(path)})


def test_snapshot_keeps_versions_and_refuses_other_columns(spark, root):
    table = tables.SnapshotTable(f"{root}/s", schemas.REFRESH_QUEUE)
    assert table.read(spark).isEmpty()
    frame = spark.createDataFrame([("2024-01-01", "2024-01-01 00:00:00")], "order_date STRING, queued_at STRING")
    assert (table.replace(frame), table.replace(table.read(spark).limit(0))) == (1, 2)
    assert table.read(spark).isEmpty() and table.read(spark, version=1).count() == 1
    assert table.read(spark, version=1).schema == schemas.REFRESH_QUEUE
    (Path(root) / "s" / "version=3").mkdir()
    assert table.versions(spark) == [1, 2]
    with pytest.raises(ValueError, match="declared"):
        table.replace(frame.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="version"):
        table.read(spark, version=9)


def test_publishing_replaces_named_slices_only_and_can_be_repeated(spark, root):
    table = tables.SlicedTable(f"{root}/g", schemas.REFRESH_QUEUE, "order_date")
    rows = lambda pairs: spark.createDataFrame(pairs, "order_date STRING, queued_at STRING").select(
        F.col("order_date").cast("date"), F.col("queued_at").cast("timestamp"))
    days = lambda *names: spark.createDataFrame([(n,) for n in names], "d STRING").select(F.col("d").cast("date"))
    assert table.read(spark).isEmpty()
    table.stage(rows([("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-01")]), "w1")
    assert table.read(spark).isEmpty()
    table.publish(spark, "w1", days("2024-01-01", "2024-01-02"))
    table.stage(rows([("2024-01-03", "2024-01-01")]), "w2")
    open_before = table.read(spark)
    for k in range(2):
        table.publish(spark, "w2", days("2024-01-01", "2024-01-03"))
        assert sorted(r.order_date.day for r in table.read(spark).collect()) == [2, 3]
        # A reader that was opened before the switch sees the state before it.
        assert k or sorted(r.order_date.day for r in open_before.collect()) == [1, 2]
    table.stage(rows([("2024-01-02", "2024-01-01")]), "w3")
    for folder in ("w3", "w3", "w3"):
        table.publish(spark, folder, days("2024-01-02"))
    assert tables.child_names(spark, f"{root}/g/data").count("_folder=w1") == 0


def test_folders_are_pruned_by_slice(spark, root):
    table = tables.SlicedTable(f"{root}/g", schemas.REFRESH_QUEUE, "order_date")
    days = spark.range(40).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"))
    table.stage(days.withColumn("queued_at", F.current_timestamp()), "w")
    table.publish(spark, "w", days)
    days.limit(3).write.parquet(f"{root}/some")
    some = table.read(spark, spark.read.parquet(f"{root}/some"))
    assert some.count() == 3 and "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()


def test_an_entry_queued_by_a_slower_clock_stays(spark, root):
    queue = tables.RefreshQueue(f"{root}/q")
    entry = lambda t: spark.createDataFrame([("2024-01-01", f"2024-01-01 10:00:0{t}")], "order_date STRING, queued_at STRING").select(
        F.col("order_date").cast("date"), F.col("queued_at").cast("timestamp"))
    assert queue.pending(spark).isEmpty()
    queue.add(entry(5))
    queue.clear(queue.entries(spark))
    queue.add(entry(3))
    assert queue.pending(spark).count() == 1
    for _ in range(3):
        queue.compact(spark)
    assert queue.pending(spark).first().queued_at.second == 3
    assert len([n for n in tables.child_names(spark, f"{root}/q") if n.startswith("log=")]) == 2
    queue.clear(queue.entries(spark))
    assert queue.pending(spark).isEmpty()


@pytest.mark.parametrize("blanks", [1, 16, 17, 500])
def test_empty_fields_are_no_drift_however_many(spark, blanks):
    lines = [GOOD + "," * blanks, GOOD + "," * blanks + "X", GOOD + ',"  "' * blanks, GOOD]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i INT, line STRING")
    kept = frame.filter(surplus_line(F.col("line")).isNotNull()).select("i").collect()
    assert [row.i for row in kept] == [1]


def test_extract_with_fractional_quantities_is_refused(spark, root):
    path = Path(root) / "a.csv"
    path.write_text(EXTRACT.replace("C3,21,A,2.0", "C3,21,A,2.5"))
    with pytest.raises(ValueError, match="1 rows with a fractional"):
        read_extracts(spark, {"Year 1": str(path)})


def test_scratch_follows_the_session(spark):
    first, second = scratch.new_dir(spark, "a"), scratch.new_dir(spark, "a")
    assert first != second and first.startswith(scratch.shared_dir(spark))
    configured = spark.conf.get(scratch.CHECKPOINT_CONF, None)
    if configured:
        assert scratch.shared_dir(spark) == configured.rstrip("/")
