"""The sales analysis end to end: two extracts to every metric frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.retail import countries, customers, extracts, lines, negatives, products, quality, sales
from tillflow.sources import scratch, tables
from tillflow.sources.extracts import read_extracts


@dataclass(frozen=True)
class Cleaned:
    """The stored and proved row ledger of two extracts; every metric starts from it."""

    ledger: DataFrame

    @property
    def analysis(self) -> DataFrame:
        """The flagged lines that the ledger leaves."""
        return lines.with_line_flags(extracts.distinct_lines(self.ledger))


def clean_once(spark: SparkSession, extract_frames: list[DataFrame], folder: str) -> Cleaned:
    """Store the ledger in `folder` and prove the overlap exact; nothing is worked out from extracts that differ."""
    extracts.row_ledger(extracts.pair_extracts(extract_frames)).write.parquet(folder)
    ledger = spark.read.parquet(folder)
    extracts.require_exact_copy(ledger)
    return Cleaned(ledger)


def metric_frames(cleaned: Cleaned) -> dict[str, DataFrame]:
    analysis, ledger = cleaned.analysis, cleaned.ledger
    monthly = sales.monthly_sales(analysis)
    summary = customers.customer_summary(analysis)
    by_country = countries.country_summary(analysis)
    data_end = analysis.agg(F.max("invoice_date").cast("date")).scalar()
    return {
        "cleaning_audit": extracts.cleaning_audit(ledger),
        "overlap_check": extracts.overlap_check(ledger),
        "overlap_impact": extracts.overlap_impact(ledger),
        "quality_scorecard": quality.quality_scorecard(ledger),
        "headline_metrics": quality.headline_metrics(analysis),
        "overview": quality.overview(analysis),
        "monthly_sales": monthly,
        "peak_months": sales.peak_months(monthly, data_end),
        "seasonality_share": sales.seasonality_share(monthly),
        "customer_concentration": customers.customer_concentration(summary),
        "repeat_purchase": customers.repeat_purchase(summary),
        "country_summary": by_country,
        "top_countries": countries.top_countries(by_country),
        "product_summary": products.product_summary(analysis),
        "top_products": products.top_products(analysis),
        "negative_breakdown": negatives.negative_breakdown(analysis),
        "top_negative_lines": negatives.top_negative_lines(analysis),
        "extreme_lines": negatives.extreme_lines(analysis),
    }


def run_report(spark: SparkSession, paths: dict[str, str], out: str) -> None:
    """Read two exported sheets and write every metric frame below `out`."""
    frames = read_extracts(spark, paths)
    folder = scratch.new_dir(spark, "ledger")
    try:
        cleaned = clean_once(spark, frames, folder)
        extracts.extract_summary(frames).write.mode("overwrite").parquet(f"{out}/extract_summary")
        for name, frame in metric_frames(cleaned).items():
            frame.write.mode("overwrite").parquet(f"{out}/{name}")
    finally:
        tables.discard(spark, folder)
