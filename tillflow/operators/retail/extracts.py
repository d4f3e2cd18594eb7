"""Overlap between two extracts: proof, removal, exact de-duplication, impact.

The two extracts meet once, in `row_ledger`: one row per distinct line with the
number of copies each extract holds, in all and inside the overlap. The overlap
proof, the cleaning audit and the de-duplicated lines all read from it, so the
whole cleaning step costs one shuffle, and map-side sums fold a line that is
repeated any number of times before it is moved.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions import retail
from tillflow.operators.validate import ValidationError
from tillflow.schemas import EXTRACT_COLUMNS, RETAIL_MONEY


class OverlapMismatch(ValidationError):
    """The extracts overlap in time but the overlapping rows are not copies."""


@dataclass(frozen=True)
class ExtractPair:
    """Two extracts in order of their first date, and the bounds of their overlap."""

    older: DataFrame
    newer: DataFrame
    # Microseconds since 1970, so that no local time zone comes between.
    newer_start: int
    older_end: int

    @property
    def overlaps(self) -> bool:
        return self.newer_start <= self.older_end

    def older_kept(self) -> Column:
        """Older rows that stay: those before the newer extract begins."""
        if not self.overlaps:
            return F.lit(True)
        return retail.is_true(F.col("invoice_date") < F.timestamp_micros(F.lit(self.newer_start)))

    def older_overlap(self) -> Column:
        if not self.overlaps:
            return F.lit(False)
        return retail.is_true(F.col("invoice_date") >= F.timestamp_micros(F.lit(self.newer_start)))

    def newer_overlap(self) -> Column:
        if not self.overlaps:
            return F.lit(False)
        return retail.is_true(F.col("invoice_date") <= F.timestamp_micros(F.lit(self.older_end)))


def extract_summary(extracts: list[DataFrame]) -> DataFrame:
    """Rows and date range per extract."""
    return reduce(DataFrame.unionByName, extracts).groupBy("source_sheet").agg(
        F.count("*").alias("row_count"),
        F.min("invoice_date").alias("min_date"),
        F.max("invoice_date").alias("max_date"),
    )


def pair_extracts(extracts: list[DataFrame]) -> ExtractPair:
    """Order exactly two extracts by their first date.

    Reads two dates per extract to the driver, so that later filters reach the
    scan as literals.
    """
    if len(extracts) != 2:
        raise ValueError(f"expected two extracts, found {len(extracts)}")
    moment = F.unix_micros("invoice_date")
    both = reduce(DataFrame.union, [e.select(F.lit(i).alias("i"), moment.alias("t")) for i, e in enumerate(extracts)])
    bounds = {row.i: row for row in both.groupBy("i").agg(F.min("t").alias("start"), F.max("t").alias("end")).collect()}
    if any(i not in bounds or bounds[i].start is None for i in range(2)):
        raise ValueError("an extract holds no dated rows")
    old, new = sorted(range(2), key=lambda i: bounds[i].start)
    return ExtractPair(extracts[old], extracts[new], bounds[new].start, bounds[old].end)


def row_ledger(pair: ExtractPair) -> DataFrame:
    """Each distinct line with its copies per extract and in the overlap."""
    def counted(frame: DataFrame, **counts: Column) -> DataFrame:
        return frame.select(*EXTRACT_COLUMNS, *[c.cast("bigint").alias(name) for name, c in counts.items()])

    none, every = F.lit(0), F.lit(1)
    older = counted(
        pair.older,
        older_rows=every, older_kept=pair.older_kept(), older_overlap=pair.older_overlap(),
        newer_rows=none, newer_overlap=none,
    )
    newer = counted(
        pair.newer,
        older_rows=none, older_kept=none, older_overlap=none,
        newer_rows=every, newer_overlap=pair.newer_overlap(),
    )
    counts = ["older_rows", "older_kept", "older_overlap", "newer_rows", "newer_overlap"]
    return (
        older.unionByName(newer)
        .groupBy(*EXTRACT_COLUMNS)
        .agg(*[F.sum(name).alias(name) for name in counts])
        .withColumn("kept_rows", F.col("older_kept") + F.col("newer_rows"))
    )


def overlap_check(ledger: DataFrame) -> DataFrame:
    """Overlapping rows per extract and how many are exact copies, repeats counted."""
    total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
    return ledger.agg(
        total(F.col("older_overlap")).alias("older_overlap_rows"),
        total(F.col("newer_overlap")).alias("newer_overlap_rows"),
        total(F.least("older_overlap", "newer_overlap")).alias("identical_rows"),
    ).withColumn(
        "is_exact_copy",
        (F.col("older_overlap_rows") == F.col("identical_rows"))
        & (F.col("newer_overlap_rows") == F.col("identical_rows")),
    )


def require_exact_copy(ledger: DataFrame) -> None:
    found = overlap_check(ledger).first()
    if not found.is_exact_copy:
        raise OverlapMismatch(f"overlapping rows are not exact copies: {found.asDict()}")


def inside_overlap(pair: ExtractPair) -> ExtractPair:
    """The rows of both extracts that lie in the overlap."""
    older, newer = pair.older.filter(pair.older_overlap()), pair.newer.filter(pair.newer_overlap())
    return replace(pair, older=older, newer=newer)


def resolve_overlap(pair: ExtractPair) -> DataFrame:
    """Both extracts as one, the newer one kept where they overlap.

    Only rows inside the overlap are compared: the others count as none on either side.
    """
    require_exact_copy(row_ledger(inside_overlap(pair)))
    return pair.older.filter(pair.older_kept()).unionByName(pair.newer)


def distinct_lines(ledger: DataFrame) -> DataFrame:
    """The lines that remain after overlap removal and exact de-duplication."""
    return ledger.filter(F.col("kept_rows") > 0).select(*EXTRACT_COLUMNS)


def cleaning_audit(ledger: DataFrame) -> DataFrame:
    """Row counts through the cleaning steps, in long form."""
    identical = F.sum(F.least("older_overlap", "newer_overlap"))
    final = F.count_if(F.col("kept_rows") > 0)
    kept = F.sum("kept_rows")
    counts = ledger.agg(
        F.sum(F.col("older_rows") + F.col("newer_rows")).alias("rows_in_extracts"),
        identical.alias("overlap_rows_removed"),
        kept.alias("rows_after_overlap"),
        (kept - final).alias("exact_duplicates_removed"),
        final.alias("final_rows"),
    )
    return counts.unpivot([], counts.columns, "step", "row_count")


def overlap_impact(ledger: DataFrame) -> DataFrame:
    """What the overlap would add to gross sales, and what de-duplication took off.

    The inflation counts every positive line, cancelled invoices too, while
    gross sales leave those out; both follow their stated definitions.
    """
    value = F.col("quantity") * F.col("unit_price")
    positive = retail.is_true(F.col("quantity") > 0) & retail.is_true(F.col("unit_price") > 0)
    sale = retail.is_sale(F.col("quantity"), F.col("unit_price"), F.col("invoice"))
    kept = F.col("kept_rows") > 0
    amounts = ledger.agg(
        F.sum(F.when(positive, value * F.col("older_overlap"))).alias("inflation"),
        F.sum(F.when(sale, value * F.col("kept_rows"))).alias("before"),
        F.sum(F.when(sale & kept, value)).alias("after"),
    )
    zero = lambda column: F.coalesce(F.col(column), F.lit(0)).cast(RETAIL_MONEY)
    return amounts.select(
        zero("inflation").alias("overlap_gross_inflation"),
        zero("before").alias("gross_before_dedup"),
        zero("after").alias("gross_sales"),
        retail.share(F.col("before") - F.col("after"), F.col("before")).alias("dedup_sales_impact"),
    )
