"""What tasks hold and shuffles move stays in proportion to the input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import parsing
from tillflow.operators import classify, profile, upsert, versions
from tillflow.operators.retail import extracts, quality
from tillflow.plans import views
from tillflow.plans.catalogue import QUERIES
from tillflow.plans.pipeline import Layout
from tillflow.session import MAX_PARTITION_BYTES
from tillflow.sources import tables
from tillflow.streaming.silver import SilverBatch, run_silver

SF_DIR = "/root/testdata/sf0.001"
READ = "spark.sql.files.maxPartitionBytes"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("asked, expected", [("128MB", MAX_PARTITION_BYTES), ("4MB", 4 << 20)])
def test_tasks_read_blocks_of_bounded_size(spark, asked, expected):
    before = spark.conf.get(READ)
    try:
        spark.conf.set(READ, asked)
        views.table(spark, SF_DIR, "orders")
        assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == expected
    finally:
        spark.conf.set(READ, before)


@pytest.mark.parametrize("view", [views.messy_orders, views.retail_lines])
def test_lines_move_once_and_narrow(spark, view):
    text = plan(view(spark, SF_DIR))
    assert "REBALANCE" not in text.upper()
    # Customers meet the orders below the join with the lines.
    assert text.index("l_orderkey") < text.index("o_custkey")
    below = text[text.index("FileScan parquet [l_orderkey"):]
    assert "c_custkey" in below and "c_custkey" not in text[: text.index("FileScan parquet [l_orderkey")].split("SortMergeJoin")[0]


@pytest.mark.parametrize("name", ["bronze_orders", "silver_orders"])
def test_stored_views_are_packed(spark, name):
    folder = views.landed_path(spark, SF_DIR, name)
    files = [file for file in tables.child_names(spark, folder) if file.startswith("part-")]
    assert files and all(f".{tables.CODEC}." in file for file in files)


def test_tables_are_packed(spark, root):
    tables.AppendTable(f"{root}/a", schemas.REFRESH_QUEUE).append(spark.createDataFrame([], schemas.REFRESH_QUEUE))
    tables.write_counted(spark.range(9), f"{root}/b", n=F.count("*"))
    for part in ("a", "b"):
        files = [file for file in tables.child_names(spark, f"{root}/{part}") if file.startswith("part-")]
        assert files and all(f".{tables.CODEC}." in file for file in files)


def test_distinct_values_are_counted_column_by_column(spark):
    frame = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "k STRING, v STRING")
    found = frame.agg(F.count("*").alias("n")).select("n", *profile.distinct_counts(frame, ["k", "v"]))
    assert "Expand" not in plan(found)
    assert found.collect() == [(3, 2, 1)]
    assert spark.range(1).select(*profile.distinct_counts(frame.filter("false"), ["k"])).first()[0] == 0


def test_overlap_is_proved_by_the_rows_inside_it(spark):
    pair = extracts.pair_extracts(views.retail_extracts(spark, SF_DIR))
    whole, inside = extracts.row_ledger(pair), extracts.row_ledger(extracts.inside_overlap(pair))
    assert extracts.overlap_check(inside).first() == extracts.overlap_check(whole).first()
    assert 0 < inside.count() == whole.filter("older_overlap + newer_overlap > 0").count() < whole.count() / 2
    apart = extracts.ExtractPair(pair.older.limit(3), pair.newer.limit(3), 2, 1)
    assert extracts.row_ledger(extracts.inside_overlap(apart)).isEmpty()


def test_overview_expands_no_line(spark):
    found = QUERIES["overview"](spark, SF_DIR)
    assert "Expand" not in plan(found)
    lines = QUERIES["line_flags"](spark, SF_DIR)
    row, sales = found.first(), lines.filter("is_sale_line")
    assert row.invoices == lines.agg(F.countDistinct("invoice")).first()[0]
    assert row.sale_invoices == sales.agg(F.countDistinct("invoice")).first()[0]
    assert row.identified_customers == sales.agg(F.countDistinct("customer_id")).first()[0]


def test_overview_of_nothing(spark):
    row = quality.overview(QUERIES["line_flags"](spark, SF_DIR).filter("false")).first()
    assert (row.row_count, row.invoices, row.sale_invoices, row.countries, row.first_date) == (0, 0, 0, 0, None)


def test_changes_move_only_what_they_need(spark):
    held, incoming = (views.landed(spark, SF_DIR, name) for name in ("held_orders", "incoming_orders"))
    found = upsert.net_changes(held, incoming)
    assert "customer_id" not in plan(found) and "unhex(" in plan(found)
    whole = upsert.order_changes(upsert.winning_versions(held, incoming))
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()


def test_held_and_incoming_orders_meet_where_they_lie(spark):
    held, incoming = (views.landed(spark, SF_DIR, name) for name in ("held_orders", "incoming_orders"))
    assert "Exchange" not in plan(upsert.upsert_orders(held, incoming))
    assert "Exchange" not in plan(upsert.net_changes(held.hint("merge"), incoming.hint("merge")))


def test_slices_of_a_year_are_written_where_rows_are(spark, root):
    orders = views.landed(spark, SF_DIR, "incoming_orders").repartition(4)
    for unit, files in (("year", 4), ("month", 1)):
        layout = Layout(f"{root}/{unit}", slice_unit=unit)
        layout.orders.stage(layout.silver.with_slice(orders), "w")
        slices = [n for n in tables.child_names(spark, f"{layout.orders._data}/_folder=w") if n.startswith("_slice=1995-01-01")]
        names = tables.child_names(spark, f"{layout.orders._data}/_folder=w/{slices[0]}")
        assert sum(n.endswith(".parquet") for n in names) == files
        assert layout.orders.staged(spark, "w").count() == orders.count()


def test_versions_move_their_hashes_as_bytes(spark):
    newest = versions.latest_version(views.sales_lines(spark, SF_DIR))
    text = plan(newest)
    assert "unhex(" in text[text.index("Exchange hashpartitioning(order_id"):]
    assert newest.filter("_record_hash rlike '^[0-9a-f]{64}$'").count() == newest.count()


def test_versions_of_a_batch_meet_where_they_lie(spark, root):
    latest = versions.latest_version(views.sales_lines(spark, SF_DIR))
    found = {}
    for part, rows in (("held", latest.filter("quantity < 20")), ("latest", latest)):
        counted = tables.write_buckets(rows, f"{root}/{part}", "order_id", n=F.count("*"))
        found[part] = tables.read_buckets(spark, f"{root}/{part}")
        assert counted["n"] == found[part].count() == spark.read.parquet(f"{root}/{part}").count()
    winners = upsert.winning_versions(found["held"].hint("merge"), found["latest"])
    assert "Exchange" not in plan(winners)
    tables.forget_buckets(spark, f"{root}/held", f"{root}/latest")
    assert spark.read.parquet(f"{root}/latest").count() == latest.count()


def _bronze(spark, root, rows):
    names = [*schemas.ORDER_FIELDS, "_source_file"]
    frame = spark.createDataFrame(rows, ", ".join(f"{name} STRING" for name in names))
    frame = frame.withColumns({"_rescued_data": F.lit(None).cast("string"), "_ingested_at": F.lit("2024-02-01").cast("timestamp")})
    frame.select(*schemas.BRONZE_ORDERS.names).coalesce(1).write.mode("append").parquet(f"{root}/bronze")
    return f"{root}/bronze"


def test_rejects_lie_in_slices_and_are_known_again_without_a_date_in_their_file(spark, root):
    files = [f"orders_202{year}-0{month}-03.csv" for year in (3, 4) for month in range(1, 7)] + ["orders_resend.csv"]
    rows = [(f"O{n}", "never", "C", "P", "1", "2.00", "west", name) for n, name in enumerate(files)]
    bronze = _bronze(spark, root, rows + [("O99", "2024-01-02", "C", "P", "1", "2.00", "west", files[0])])
    for unit, folders in (("year", 3), (None, 13)):
        layout = Layout(f"{root}/{unit}", slice_unit=unit)
        for rebuild in (False, True):
            run_silver(spark, bronze, layout.silver, layout.checkpoint("silver"), "t", rebuild=rebuild)
        held = layout.quarantine.read(spark)
        assert held.count() == 13 and {row[0] for row in held.select("_source_file").collect()} == set(files)
        part = f"{layout.quarantine.path}/_part=silver-0-0"
        assert sum(name.startswith("_batch_date=") for name in tables.child_names(spark, part)) == folders
        assert layout.orders.read(spark).count() == 1


def test_rejects_that_lie_by_day_are_known_to_slices_of_a_year(spark, root):
    rows = [("O1", "never", "C", "P", "1", "2.00", "west", name) for name in ("orders_2024-05-03.csv", "orders_resend.csv")]
    bronze, layout = _bronze(spark, root, rows), Layout(f"{root}/t", slice_unit="year")
    old = classify.rejected_rows(classify.classify(spark.read.parquet(bronze))).withColumns({
        "_quarantined_at": F.current_timestamp(), "_batch_date": parsing.file_date(F.col("_source_file")),
    })
    layout.quarantine.put(old, "silver-old")
    run_silver(spark, bronze, layout.silver, layout.checkpoint("silver"), "t")
    assert layout.quarantine.read(spark).count() == 2


def test_new_rows_are_told_by_hashes_before_whole_keys(spark):
    source = spark.range(50).selectExpr("nullif(id % 7, 0) a", "cast(id % 3 as string) b", "id")
    held = source.filter("id % 2 = 0").unionByName(source.filter("id % 2 = 0"))
    new = upsert.insert_new(held.hint("merge"), source.hint("merge"), ["a", "b"])
    text = plan(new)
    assert "Sort [xxhash64(a" in text
    keys = {(r.a, r.b) for r in held.collect()}
    assert sorted(r.id for r in new.collect()) == sorted(r.id for r in source.collect() if (r.a, r.b) not in keys)
    assert upsert.insert_new(source, source.unionByName(source), ["a", "b"]).isEmpty()


def test_only_what_decides_an_upsert_moves_and_the_index_meets_its_batch_in_buckets(spark, root):
    latest = versions.latest_version(views.sales_lines(spark, SF_DIR))
    near = upsert.deciding(latest.filter("quantity < 20"))
    assert "_record_hash" in near.columns and not {"customer_id", "unit_price"} & set(near.columns)
    layout = Layout(f"{root}/t", slice_unit="year")
    slices = layout.silver.with_slice(latest).select("order_id", "_slice")
    known = slices.filter("order_id like '%1'").unionByName(slices.limit(50).withColumn("_slice", F.lit(None).cast("date")))
    parts = {"latest": latest, "known": known.distinct(), "ids": latest.select("order_id", (F.col("quantity") < 30).alias("valid"))}
    for name, frame in parts.items():
        tables.write_buckets(frame, f"{root}/{name}", "order_id")
        parts[name] = tables.read_buckets(spark, f"{root}/{name}")
    found = SilverBatch(layout.silver, root, "t", "t")._new_entries(parts["ids"].hint("merge"), parts["known"].hint("merge"), parts["latest"].hint("merge"))
    assert "Exchange" not in plan(found) and "Sort [" not in plan(found)
    wanted = slices.unionByName(parts["ids"].filter("NOT valid").select("order_id", F.lit(None).cast("date").alias("_slice")))
    plain = wanted.alias("n").join(known.distinct().alias("k"), F.expr("n.order_id = k.order_id AND n._slice <=> k._slice"), "left_anti")
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty() and not found.isEmpty()
    path = f"{root}/ids"
    tables.forget_buckets(spark, path)
    assert tables.read_buckets(spark, path, "order_id STRING, valid BOOLEAN").count() == latest.count()


def test_whole_numbers_cost_no_failed_cast(spark):
    texts = ["7", " -7 ", "+7", "\t7\t", "2.0", "", "x", "7x", "--7", "7 7", "2147483648", None]
    frame = spark.createDataFrame([(text,) for text in texts], "t STRING")
    same = frame.select(parsing.quantity(F.col("t")).eqNullSafe(F.trim("t").try_cast("int")).alias("same"))
    assert same.filter("NOT same").isEmpty()
