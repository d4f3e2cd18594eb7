"""Classification, versions, upserts, queue, products, checks on small frames."""

from __future__ import annotations

import itertools
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import (
    classify, gold, products, profile, ranking, reconcile, refresh, snapshot, upsert, validate, versions,
)

T0 = datetime(2024, 1, 5, 8)
T1 = datetime(2024, 1, 5, 9)


def bronze(spark, rows):
    """Rows of seven fields, file, and optionally rescued line and ingest time."""
    full = [(*r[:7], r[8] if len(r) > 8 else None, r[7], r[9] if len(r) > 9 else T0) for r in rows]
    return spark.createDataFrame(full, schemas.BRONZE_ORDERS)


def order(order_id="O1", day="2024-01-01", qty="1", price="2.00", region="East", file="orders_2024-01-01.csv", **more):
    return (order_id, day, "C1", more.get("product", "P1"), qty, price, region, file, more.get("rescued"), more.get("at", T0))


def test_first_failing_check_names_the_reason(spark):
    rows = [
        order(order_id=" ", day="bad", qty="x", price="x"),
        order(day="bad", qty="x", price="x"),
        order(qty="x", price="x"),
        order(price="x"),
        order(price="-1.00"),
        order(),
    ]
    reasons = [r.reject_reason for r in classify.classify(bronze(spark, rows)).collect()]
    assert reasons == [
        "missing_order_id", "unparseable_order_date", "missing_or_invalid_quantity", "missing_or_invalid_unit_price",
        "negative_unit_price", None,
    ]


def test_unusual_rows_are_kept_and_flagged(spark):
    rows = [order("A", qty="0"), order("B", qty="-1"), order("C", rescued="raw line"), order("D", file="orders.csv")]
    typed = classify.classify(bronze(spark, rows))
    kept = {r.order_id: r for r in versions.latest_version(classify.valid_rows(typed)).collect()}
    assert kept["A"].is_zero_quantity and not kept["A"].is_return
    assert kept["B"].is_return and kept["B"].line_revenue == Decimal("-2.00")
    assert kept["C"].has_schema_drift and not kept["A"].has_schema_drift
    assert kept["D"]._source_batch_date is None
    assert classify.rejected_rows(typed).count() == 0


def test_latest_version_orders_by_batch_date_then_time_then_file_then_hash(spark):
    late, early = "orders_2024-01-02.csv", "orders_2024-01-01.csv"
    rows = [
        order("batch", qty="1", file=late, at=T0), order("batch", qty="2", file=early, at=T1),
        order("time", qty="1", file=early, at=T0), order("time", qty="2", file=early, at=T1),
        order("file", qty="1", file="orders_2024-01-01_a.csv"), order("file", qty="2", file="orders_2024-01-01_b.csv"),
        order("undated", qty="1", file="orders.csv", at=T1), order("undated", qty="2", file=early, at=T0),
        order("hash", qty="1"), order("hash", qty="2"),
    ]
    typed = versions.with_record_hash(classify.valid_rows(classify.classify(bronze(spark, rows))))
    found = {r.order_id: r.quantity for r in versions.latest_version(typed).collect()}
    hashes = {r.quantity: r._record_hash for r in typed.filter("order_id = 'hash'").collect()}
    assert found == {"batch": 1, "time": 2, "file": 2, "undated": 2, "hash": max(hashes, key=hashes.get)}


def silver(spark, rows):
    return versions.latest_version(classify.valid_rows(classify.classify(bronze(spark, rows))))


def contents(frame):
    return sorted(tuple(str(v) for v in row) for row in frame.collect())


def test_upsert_is_idempotent_and_ignores_arrival_order(spark):
    """Any way of cutting the arrivals into batches ends in the same table."""
    rng = random.Random(7)
    files = ["orders_2024-01-01.csv", "orders_2024-01-02.csv", "orders_2024-01-02_b.csv", "orders_x.csv"]
    rows = [
        order(f"O{rng.randrange(6)}", f"2024-01-0{rng.randrange(1, 4)}", str(rng.randrange(9)), file=rng.choice(files), at=rng.choice([T0, T1]))
        for _ in range(40)
    ]
    want = contents(silver(spark, rows))
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        cuts = sorted(random.Random(seed).sample(range(1, 40), seed))
        table = spark.createDataFrame([], schemas.SILVER_ORDERS)
        for start, end in itertools.pairwise([0, *cuts, 40]):
            batch = silver(spark, rows[start:end])
            table = upsert.upsert_orders(table, batch)
        assert contents(table) == want
        assert contents(upsert.upsert_orders(table, silver(spark, rows))) == want


def test_upsert_condition_term_by_term(spark):
    day1, day2 = date(2024, 1, 1), date(2024, 1, 2)
    #        batch t, s      time t, s    file t, s     hash t, s  source wins
    cases = [
        (None, day1, T0, T0, "a", "a", "1", "1", True),
        (day1, None, T0, T1, "a", "b", "1", "2", False),
        (day1, day2, T1, T0, "b", "a", "2", "1", True),
        (day2, day1, T0, T1, "a", "b", "1", "2", False),
        (day1, day1, None, T0, "a", "a", "1", "1", True),
        (day1, day1, T0, None, "a", "b", "1", "2", False),
        (day1, day1, T0, T1, "b", "a", "1", "1", True),
        (day1, day1, T1, T0, "a", "b", "1", "2", False),
        (day1, day1, T0, T0, None, "a", "1", "1", True),
        (day1, day1, T0, T0, "a", "b", "1", "1", True),
        (day1, day1, T0, T0, "b", "a", "1", "2", False),
        (day1, day1, T0, T0, "a", "a", "1", "2", True),
        (day1, day1, T0, T0, "a", "a", "1", "1", False),
        (None, None, T0, T0, "a", "b", "1", "1", True),
        (None, None, T0, T0, "a", "a", "1", "1", False),
    ]
    kind = "struct<_source_batch_date:date,_ingested_at:timestamp,_source_file:string,_record_hash:string>"
    rows = [(i, (bt, tt, ft, ht), (bs, ts, fs, hs)) for i, (bt, bs, tt, ts, ft, fs, ht, hs, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, f"n INT, t {kind}, s {kind}").orderBy("n")
    wins = [bool(r[0]) for r in frame.select(upsert.source_wins(F.col("t"), F.col("s"))).collect()]
    assert wins == [case[-1] for case in cases]


def test_quarantine_insert_keeps_repeats_of_one_batch_and_skips_known_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a STRING, b STRING")
    new = upsert.insert_new(frame([("x", None), (None, None)]), frame([("x", None), (None, None), ("x", "1"), ("x", "1")]), ["a", "b"])
    assert contents(new) == [("x", "1"), ("x", "1")]


def test_affected_dates_cover_where_an_order_comes_from_and_goes_to(spark):
    held = silver(spark, [order("A", "2024-01-01"), order("B", "2024-01-07")])
    incoming = silver(spark, [order("A", "2024-01-02", file="orders_2024-01-02.csv")])
    assert {r[0].day for r in refresh.affected_dates(held, incoming).collect()} == {1, 2}


def test_changed_products_are_added_removed_or_altered(spark):
    frame = lambda rows: spark.createDataFrame(rows, "product_id STRING, product_name STRING, category STRING, list_price DECIMAL(12,2)")
    one, two = Decimal("1.00"), Decimal("2.00")
    old = frame([("same", "n", None, one), ("gone", "n", "c", one), ("price", "n", "c", one), ("null", None, "c", one)])
    new = frame([("same", "n", None, one), ("new", "n", "c", one), ("price", "n", "c", two), ("null", "n", "c", one)])
    assert {r[0] for r in refresh.changed_products(new, old).collect()} == {"gone", "new", "price", "null"}


def test_conformed_products_do_not_depend_on_row_order(spark):
    rows = [(" P1 ", "b", "kitchen", "1.00"), ("P1", "a", "Kitchen", "2.00"), ("P1", None, "x", "3"), ("", "n", "c", "1"), (None, "n", "c", "1"), ("P2", "n", None, "x")]
    for _ in range(3):
        random.shuffle(rows)
        frame = spark.createDataFrame(rows, "product_id STRING, product_name STRING, category STRING, list_price STRING")
        assert contents(products.conform_products(frame)) == [("P1", "b", "Kitchen", "1.00"), ("P2", "n", "None", "None")]


def test_gold_counts_distinct_orders_and_keeps_unknown_products(spark):
    rows = [("A", date(2024, 1, 1), "P1", "East", 1, Decimal("2.00")), ("A", date(2024, 1, 1), "P1", "East", 1, Decimal("3.01")), ("B", date(2024, 1, 1), "?", "East", 2, Decimal("4.00"))]
    orders = spark.createDataFrame(rows, "order_id STRING, order_date DATE, product_id STRING, region STRING, quantity INT, line_revenue DECIMAL(14,2)")
    ref = spark.createDataFrame([("P1", "Kitchen")], "product_id STRING, category STRING")
    found = {r.category: r for r in gold.daily_sales(orders, ref).collect()}
    assert (found["Kitchen"].order_count, found["Kitchen"].aov, found["Kitchen"].units_sold) == (1, Decimal("5.01"), 2)
    assert found["Unknown"].net_revenue == Decimal("4.00")
    distinct = orders.dropDuplicates(["order_id"])
    assert contents(gold.daily_sales(distinct, ref)) == contents(gold.daily_sales(distinct, ref, unique_orders=True))


def test_contract_counts_unknown_as_broken(spark):
    frame = spark.createDataFrame([("a", None), ("", Decimal("1.00")), ("b", Decimal("-1.00"))], "region STRING, unit_price DECIMAL(12,2)")
    rules = {k: v for k, v in validate.order_rules().items() if k in ("unit_price_non_negative", "region_present")}
    assert validate.contract_violations(frame, rules).first().asDict() == {"unit_price_non_negative": 2, "region_present": 1}
    with pytest.raises(validate.ValidationError, match="unit_price_non_negative"):
        validate.enforce_contract(frame, rules, "t")


def test_gate_rejects_repeats_missing_fields_and_lost_revenue(spark):
    orders = silver(spark, [order("A"), order("B")])
    cells = gold.daily_sales(orders, spark.createDataFrame([], "product_id STRING, category STRING"))
    assert validate.gate(orders, cells).net_revenue == Decimal("4.00")
    with pytest.raises(validate.ValidationError, match="repeats"):
        validate.gate(orders.unionByName(orders), cells)
    with pytest.raises(validate.ValidationError, match="required"):
        validate.gate(orders.withColumn("region", F.lit(None).cast("string")), cells)
    with pytest.raises(validate.ValidationError, match="revenue"):
        validate.gate(orders, cells.withColumn("net_revenue", F.col("net_revenue") + 1))
    with pytest.raises(validate.ValidationError, match="queue kept"):
        validate.verify_published(cells.limit(0), validate.cell_stats(cells).first())


def test_row_balance_reads_trimmed_ids_once(spark):
    rows = [order("A"), order("A ", day="bad"), order(" B", qty="x"), order("C"), order("  "), order(" ")]
    raw = bronze(spark, rows)
    typed = classify.classify(raw)
    found = reconcile.row_balance(raw, versions.latest_version(classify.valid_rows(typed)), classify.rejected_rows(typed)).first()
    assert found.asDict() == {"rows_in": 3, "loaded": 2, "quarantined": 1, "missing_id_rows": 2, "balanced": True}
    lost = reconcile.row_balance(raw, silver(spark, rows).filter("order_id <> 'C'"), classify.rejected_rows(typed)).first()
    assert not lost.balanced


def test_snapshot_diff_compares_copies_not_just_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a STRING, n INT")
    before, after = frame([("x", 1), ("x", 1), ("y", None)]), frame([("x", 1), ("y", None), ("z", 2)])
    assert contents(snapshot.snapshot_diff(before, after)) == [("x", "1", "2", "1"), ("z", "2", "0", "1")]
    assert snapshot.snapshot_diff(before, before).isEmpty()


def test_global_rank_numbers_every_row_once(spark):
    rows = [(i, i * 7919 % 101) for i in range(2000)]
    frame = spark.createDataFrame(rows, "id INT, v INT").repartition(7)
    ranked = ranking.global_rank(frame, F.desc("v"), F.asc("id")).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r.id, r.v) for r in sorted(ranked, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked) == list(range(1, 2001))


def test_table_counts_are_in_long_form(spark):
    raw = bronze(spark, [order("A"), order("A")])
    assert contents(profile.table_counts({"one": raw, "none": raw.limit(0)})) == [("none", "0"), ("one", "2")]
    assert contents(profile.version_counts(raw)) == [("A", "2")]


@pytest.mark.parametrize("spread", [3, 10**6, 10**17])
def test_largest_values_are_summed_without_a_sort(spark, spread):
    """Any cut, with ties, negative values, nulls, and values far apart."""
    pick = random.Random(spread)
    values = [Decimal(pick.randrange(-spread, spread)).scaleb(-4) for _ in range(400)] + [None] * 3
    frame = spark.createDataFrame([(v,) for v in values], "v DECIMAL(22,4)")
    ordered = sorted((v for v in values if v is not None), reverse=True)
    cuts = [1, 2, 17, 200, 399, 400, 402, 403]
    found = ranking.largest_values(frame, "v", cuts, percents=[1, 5, 100])
    assert found.rows == 403 and found.total == sum(ordered)
    assert {n: found.sums[n] for n in [*cuts, 5, 21]} == {n: sum(ordered[:n]) for n in [*cuts, 5, 21]}


def test_largest_of_nothing_and_of_equal_values(spark):
    empty = ranking.largest_values(spark.createDataFrame([], "v DECIMAL(10,2)"), "v", [3])
    assert (empty.rows, empty.total, empty.sums) == (0, None, {3: None})
    same = spark.createDataFrame([(Decimal("2.50"),)] * 40, "v DECIMAL(10,2)")
    assert ranking.largest_values(same, "v", [7], [50]).sums == {7: Decimal("17.50"), 20: Decimal("50.00")}
