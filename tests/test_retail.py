"""Retail cleaning and metrics against a brute-force reading of small extracts."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from tillflow import schemas
from tillflow.operators.retail import countries, customers, extracts, lines, negatives, products, quality, sales
from tillflow.plans import report

SCHEMA = (
    "invoice STRING, stock_code STRING, description STRING, quantity INT, invoice_date TIMESTAMP, "
    "unit_price DECIMAL(12,4), customer_id BIGINT, country STRING, source_sheet STRING"
)
START = datetime(2010, 1, 1, 9)


def random_lines(seed: int, n: int = 300) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append((
            rng.choice(["C", "c", "", "", "", "A"]) + str(rng.randrange(60)) if rng.random() > 0.03 else None,
            rng.choice(["10", "11", "12a", "M", "POST", None]),
            rng.choice(["LAMP", "MUG", "lamp", None]),
            rng.choice([-5, -1, 0, 1, 2, 12, None]),
            START + timedelta(days=rng.randrange(700)),
            rng.choice([Decimal("2.50"), Decimal("0.001"), Decimal("0"), Decimal("-3.00"), None]),
            rng.choice([1, 2, 3, 4, 5, None]),
            rng.choice(["United Kingdom", "France", "EIRE", None]),
        ))
    return rows + rng.sample(rows, n // 3)


def two_extracts(spark, rows, cut_low=300, cut_high=400):
    """The rows as two extracts that share the days between the cuts."""
    low, high = START + timedelta(days=cut_low), START + timedelta(days=cut_high)
    old = [(*r, "old") for r in rows if r[4] <= high]
    new = [(*r, "new") for r in rows if r[4] >= low]
    return [spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA)], old, new


def flags(row):
    invoice, code, _, quantity, _, price, _, _ = row
    cancel = (invoice or "").upper().startswith("C")
    sale = bool(quantity is not None and price is not None and quantity > 0 and price > 0 and not cancel)
    negative = bool(quantity is not None and price is not None and quantity < 0 and price > 0)
    return sale, negative, bool(code and code[0].isdigit())


def value(row):
    return None if row[3] is None or row[5] is None else row[3] * row[5]


def money(amount) -> Decimal:
    return Decimal(amount).quantize(Decimal("0.0001"), rounding="ROUND_HALF_UP")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rows = random_lines(3)
    frames, old, new = two_extracts(spark, rows)
    start = min(r[4] for r in new)
    kept = [r[:8] for r in old if r[4] < start] + [r[:8] for r in new]
    cleaned = report.clean_once(spark, frames, str(tmp_path_factory.mktemp("ledger") / "l"))
    return {"old": old, "new": new, "start": start, "kept": kept, "lines": list(set(kept)), "frames": frames,
            "ledger": cleaned.ledger, "analysis": cleaned.analysis}


def test_cleaning_steps(world):
    overlap = [r[:8] for r in world["old"] if r[4] >= world["start"]]
    steps = {r.step: r.row_count for r in extracts.cleaning_audit(world["ledger"]).collect()}
    assert steps == {
        "rows_in_extracts": len(world["old"]) + len(world["new"]),
        "overlap_rows_removed": len(overlap),
        "rows_after_overlap": len(world["kept"]),
        "exact_duplicates_removed": len(world["kept"]) - len(world["lines"]),
        "final_rows": len(world["lines"]),
    }
    assert len(overlap) > len(set(overlap))
    resolved = extracts.resolve_overlap(extracts.pair_extracts(world["frames"]))
    assert Counter(tuple(r)[:8] for r in resolved.collect()) == Counter(
        (*r[:5], r[5] if r[5] is None else r[5].quantize(Decimal("0.0001")), *r[6:8]) for r in world["kept"])
    impact = extracts.overlap_impact(world["ledger"]).first()
    positive = lambda r: r[3] is not None and r[5] is not None and r[3] > 0 and r[5] > 0
    before, after = (sum(value(r) for r in rows if flags(r)[0]) for rows in (world["kept"], world["lines"]))
    assert impact.overlap_gross_inflation == money(sum(value(r) for r in overlap if positive(r)))
    assert (impact.gross_before_dedup, impact.gross_sales) == (money(before), money(after))
    assert impact.dedup_sales_impact == pytest.approx(float((before - after) / before), abs=1e-6)


def test_overlap_must_be_copies_with_repeats_counted(spark, root):
    rows = random_lines(5, 60)
    frames, old, new = two_extracts(spark, rows)
    inside = next(r for r in new if r[4] <= max(o[4] for o in old))
    again = spark.createDataFrame([*new, inside], SCHEMA)
    pair = extracts.pair_extracts([again, frames[1]])
    check = extracts.overlap_check(extracts.row_ledger(pair)).first()
    assert check.newer_overlap_rows == check.older_overlap_rows + 1 and not check.is_exact_copy
    with pytest.raises(extracts.OverlapMismatch):
        extracts.resolve_overlap(pair)
    with pytest.raises(extracts.OverlapMismatch):
        report.clean_once(spark, [again, frames[1]], f"{root}/l")


def test_extracts_that_do_not_overlap_are_joined_whole(spark):
    rows = [(*r, "old") for r in random_lines(1, 30)]
    later = [(*r[:4], r[4] + timedelta(days=3000), *r[5:8], "new") for r in rows]
    undated = (*rows[0][:4], None, *rows[0][5:8])
    old, new = spark.createDataFrame([*rows, (*undated, "old")], SCHEMA), spark.createDataFrame([*later, (*undated, "new")], SCHEMA)
    pair = extracts.pair_extracts([new, old])
    assert not pair.overlaps
    assert extracts.resolve_overlap(pair).count() == 2 * len(rows) + 2
    steps = {r.step: r.row_count for r in extracts.cleaning_audit(extracts.row_ledger(pair)).collect()}
    assert steps["overlap_rows_removed"] == 0 and steps["final_rows"] == 2 * len(set(rows)) + 1


def test_two_extracts_are_required(spark):
    one = spark.createDataFrame([(*random_lines(1, 3)[0], "x")], SCHEMA)
    with pytest.raises(ValueError, match="two extracts"):
        extracts.pair_extracts([one])
    summary = extracts.extract_summary([one, one.limit(0)]).first()
    assert (summary.source_sheet, summary.row_count) == ("x", 1)


def test_line_flags_read_missing_values_as_false(world):
    for row in world["analysis"].collect():
        got = (row.is_sale_line, row.is_negative_line, row.is_product_like_code)
        assert got == flags(tuple(row)[:8])
        assert row.is_cancel_invoice == (row.invoice or "").upper().startswith("C")
        assert row.month == date(row.invoice_date.year, row.invoice_date.month, 1)


def test_monthly_sales_and_what_is_read_from_them(world):
    by_month = defaultdict(list)
    for r in world["lines"]:
        if flags(r)[0]:
            by_month[date(r[4].year, r[4].month, 1)].append(r)
    monthly = sales.monthly_sales(world["analysis"])
    found = {r.month: r for r in monthly.collect()}
    assert set(found) == set(by_month)
    for month, rows in by_month.items():
        gross, orders = money(sum(value(r) for r in rows)), len({r[0] for r in rows} - {None})
        got = found[month]
        assert (got.gross_sales, got.orders, got.identified_customers) == (gross, orders, len({r[6] for r in rows} - {None}))
        assert got.average_order_value == (money(gross / orders) if orders else None)

    end = max(r[4] for r in world["lines"]).date()
    complete = {m: r.gross_sales for m, r in found.items() if (m.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1) <= end}
    data_end = world["analysis"].selectExpr("CAST(max(invoice_date) AS DATE) d").scalar()
    peaks = {r.year: r.gross_sales for r in sales.peak_months(monthly, data_end).collect()}
    assert peaks == {y: max(v for m, v in complete.items() if m.year == y) for y in {m.year for m in complete}}
    for r in sales.seasonality_share(monthly, [2010, 2011]).collect():
        jan_nov = sum(v.gross_sales for m, v in found.items() if m.year == r.year and m.month <= 11)
        sep_nov = sum(v.gross_sales for m, v in found.items() if m.year == r.year and m.month in (9, 10, 11))
        assert (r.jan_nov_sales, r.sep_nov_sales) == (jan_nov, sep_nov)
        assert r.sep_nov_share == pytest.approx(float(sep_nov / jan_nov), abs=1e-6)
    assert sales.selected_months(monthly, [next(iter(by_month)), date(1999, 1, 1)]).count() == 1


def test_customers(world):
    totals, orders = defaultdict(Decimal), defaultdict(set)
    for r in world["lines"]:
        if flags(r)[0] and r[6] is not None:
            totals[r[6]] += value(r)
            orders[r[6]] |= {r[0]} - {None}
    summary = customers.customer_summary(world["analysis"])
    assert {r.customer_id: (r.gross_sales, r.orders) for r in summary.collect()} == {c: (money(v), len(orders[c])) for c, v in totals.items()}
    ranked = sorted((money(v) for v in totals.values()), reverse=True)
    for r in customers.customer_concentration(summary, [1, 5, 10, 20, 50, 100]).collect():
        n = max(1, math.ceil(len(ranked) * r.top_percent / 100))
        assert (r.customers, r.gross_sales) == (n, sum(ranked[:n]))
        assert r.sales_share == pytest.approx(float(sum(ranked[:n]) / sum(ranked)), abs=1e-6)
    repeat = {r.segment: r.customers for r in customers.repeat_purchase(summary).collect()}
    assert repeat == {"One order": sum(len(o) == 1 for o in orders.values()), "Two or more orders": sum(len(o) >= 2 for o in orders.values())}


def test_a_segment_without_customers_is_still_reported(spark):
    summary = spark.createDataFrame([(1, Decimal("2.00"), 3)], "customer_id BIGINT, gross_sales DECIMAL(18,2), orders BIGINT")
    rows = [tuple(r) for r in customers.repeat_purchase(summary).collect()]
    assert rows == [("One order", 0, 0.0, 0.0), ("Two or more orders", 1, 1.0, 1.0)]


def test_countries_keep_unnamed_sales_in_the_total(world):
    sold = [r for r in world["lines"] if flags(r)[0]]
    total = sum(value(r) for r in sold)
    summary = countries.country_summary(world["analysis"])
    found = {r.country: r for r in summary.collect()}
    assert set(found) == {r[7] for r in sold} - {None}
    for country, row in found.items():
        gross = sum(value(r) for r in sold if r[7] == country)
        assert row.gross_sales == money(gross)
        assert row.sales_share == pytest.approx(float(money(gross) / total), abs=1e-6)
    assert sum(r.sales_share for r in found.values()) < 0.99
    assert countries.top_countries(summary, 1).first().gross_sales == max(r.gross_sales for r in found.values())
    assert countries.share_of_country(summary, "France").count() == 1


def test_products_and_their_usual_description(spark, world):
    found = {r.stock_code: r for r in products.description_mode(world["analysis"]).collect()}
    counts = Counter((r[1], r[2]) for r in world["lines"] if flags(r)[0] and r[1] and r[2])
    for code in {c for c, _ in counts}:
        best = min((-n, d) for (c, d), n in counts.items() if c == code)
        assert (found[code].description, found[code].line_count) == (best[1], -best[0])
    top = products.top_products(world["analysis"], 2).collect()
    gross = defaultdict(Decimal)
    for r in world["lines"]:
        if flags(r)[0] and flags(r)[2]:
            gross[r[1]] += value(r)
    want = sorted(gross, key=lambda c: (-gross[c], c))[:2]
    assert {r.stock_code: (r.gross_sales, r.description) for r in top} == {c: (money(gross[c]), found[c].description) for c in want}


def test_tied_descriptions_resolve_by_spelling(spark):
    rows = [(str(i), "1", d, 1, START, Decimal("1"), 1, "x", "s") for i, d in enumerate(["b", "a", "b", "a", "c"])]
    frame = lines.with_line_flags(spark.createDataFrame(rows, SCHEMA))
    assert products.description_mode(frame).first().description == "a"


def test_negatives_and_extremes(world):
    negative = [r for r in world["lines"] if flags(r)[1]]
    total = sum(-value(r) for r in negative)
    for row in negatives.negative_breakdown(world["analysis"]).collect():
        part = [r for r in negative if flags(r)[2] == (row.code_group == negatives.PRODUCT_LIKE)]
        assert row.negative_value == money(sum(-value(r) for r in part))
        assert row.row_count == len(part)
        assert row.negative_value_share == pytest.approx(float(sum(-value(r) for r in part) / total), abs=1e-6)
    top = negatives.top_negative_lines(world["analysis"]).collect()
    assert [r.negative_value for r in top] == sorted((-value(r) for r in negative), reverse=True)[:12]
    extreme = negatives.extreme_lines(world["analysis"]).collect()
    assert [abs(r.line_value) for r in extreme] == sorted((abs(value(r)) for r in world["lines"] if value(r) is not None), reverse=True)[:15]


def test_headline_overview_and_scorecard(world):
    rows = world["lines"]
    sold, negative = [r for r in rows if flags(r)[0]], [r for r in rows if flags(r)[1]]
    head = quality.headline_metrics(world["analysis"]).first()
    gross, lost = sum(value(r) for r in sold), sum(-value(r) for r in negative)
    net = sum(value(r) for r in rows if r[5] is not None and r[5] > 0 and value(r) is not None)
    assert (head.gross_sales, head.negative_value, head.net_transaction_value) == (money(gross), money(lost), money(net))
    assert head.missing_customer_share == pytest.approx(sum(r[6] is None for r in rows) / len(rows), abs=1e-6)
    assert head.negative_value_rate == pytest.approx(float(lost / gross), abs=1e-6)
    view = quality.overview(world["analysis"]).first()
    distinct = lambda rs, i: len({r[i] for r in rs} - {None})
    assert (view.row_count, view.invoices, view.sale_invoices) == (len(rows), distinct(rows, 0), distinct(sold, 0))
    assert (view.stock_codes, view.identified_customers, view.countries) == (distinct(sold, 1), distinct(sold, 6), distinct(sold, 7))
    card = {r.issue: r for r in quality.quality_scorecard(world["ledger"]).collect()}
    assert len(card) == 8
    assert card["Zero unit price"].row_count == sum(r[5] == 0 for r in rows)
    assert card["Negative quantity without C-prefixed invoice"].row_count == sum(
        r[3] is not None and r[3] < 0 and not (r[0] or "").upper().startswith("C") for r in rows)
    assert card["Remaining exact duplicate rows"].row_count == len(world["kept"]) - len(rows)
    assert card["Missing description"].row_share == pytest.approx(sum(r[2] is None for r in rows) / len(rows), abs=1e-6)


def test_report_writes_every_frame(spark, root, world):
    paths = {}
    for name, frame in zip(("new", "old"), world["frames"], strict=True):
        headers = {v: k for k, v in schemas.EXTRACT_HEADERS.items()}
        out = frame.selectExpr(*[f"CAST({c} AS STRING) AS `{headers[c]}`" for c in schemas.EXTRACT_COLUMNS])
        out.write.option("header", "true").csv(f"{root}/{name}")
        paths[name] = f"{root}/{name}"
    report.run_report(spark, paths, f"{root}/out")
    steps = {r.step: r.row_count for r in spark.read.parquet(f"{root}/out/cleaning_audit").collect()}
    assert steps["final_rows"] == len(world["lines"])
    assert spark.read.parquet(f"{root}/out/extract_summary").count() == 2
    assert spark.read.parquet(f"{root}/out/customer_concentration").count() == 4
