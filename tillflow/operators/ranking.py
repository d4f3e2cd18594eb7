"""Ranks over a whole table without a single-task sort, and sums of its largest values without any sort."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.sources import scratch, tables

# Ranges that an interval is cut into in one round of a selection.
RANGES = 1024
# Python's own decimals keep fewer digits than sums may have.
DIGITS = Context(prec=60)

# monotonically_increasing_id keeps the partition above this bit and the row's
# place inside the partition below it.
PLACE_BITS = 33


def global_rank(frame: DataFrame, *order: Column) -> DataFrame:
    """`frame` with its 1-based `rank` under a total order.

    A global sort leaves ranges in partition order, so a row's rank is its place
    in its partition plus the rows in the partitions before. The sorted frame is
    checkpointed because its range bounds are sampled: the places and the counts
    have to come from one and the same sort. The only frame gathered in one task
    holds one row per partition.
    """
    scratch.shared_dir(frame.sparkSession)
    placed = (
        frame.orderBy(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", PLACE_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .checkpoint()
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per partition of the sort: bounded by the shuffle settings.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )


@dataclass(frozen=True)
class LargestValues:
    """What selecting the largest values of a table found: rows, their sum, and the sum of the first `n` for each cut."""

    rows: int
    total: Decimal | None
    sums: dict[int, Decimal | None]


def largest_values(frame: DataFrame, value: str, cuts: Iterable[int] | None = None, percents: Iterable[int] = ()) -> LargestValues:
    """The sums of the `n` largest values of a decimal column, for each n of `cuts`, and for each whole percent of rows.

    A percent covers at least one row and rounds up. Nothing is sorted: every round
    counts and sums the values by range, inside the intervals that still hold a
    cut, and goes on inside the range that a cut falls into, until that range is one
    value or ends with the cut. Values that tie with the last one are alike, so it does not matter which
    of them are taken. A round gathers at most RANGES sums for each cut; a table of
    22-digit values takes eight rounds at most. Null values count as rows and come last.
    """
    spark, path = frame.sparkSession, scratch.new_dir(frame.sparkSession, "values")
    kind = frame.schema[value].dataType
    column = F.col("value")
    seen = tables.write_counted(
        frame.select(F.col(value).alias("value")), path, rows=F.count("*"), filled=F.count(column), low=F.min(column),
        high=F.max(column), total=F.sum(column),
    )
    stored = spark.read.schema(f"value {kind.simpleString()}").parquet(path)
    rows, filled = seen["rows"] or 0, seen["filled"] or 0
    wanted = [max(1, n) for n in cuts or ()] + [max(1, -(-rows * p // 100)) for p in percents]
    # Values in units of their last digit: whole numbers.
    scale = kind.scale
    unit = lambda number: int(number.scaleb(scale, DIGITS))
    units = (column * F.lit(10**scale).cast("decimal(20,0)")).cast("decimal(38,0)")
    done: dict[int, int | None] = {n: unit(seen["total"]) if filled else None for n in wanted if n >= filled}
    # Intervals of units that hold cuts: rows and units above them.
    open_at = {(unit(seen["low"]), unit(seen["high"])): ([n for n in set(wanted) if n < filled], 0, 0)} if filled else {}
    open_at = {bounds: state for bounds, state in open_at.items() if state[0]}
    while open_at:
        bounds = list(open_at)
        widths = [-(-(high - low + 1) // RANGES) for low, high in bounds]
        inside = [units.between(F.lit(Decimal(low)), F.lit(Decimal(high))) for low, high in bounds]
        at, part = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, ((low, _), width) in enumerate(zip(bounds, widths)):
            offset = (units - F.lit(Decimal(low)).cast("decimal(38,0)")).cast("decimal(38,0)")
            at = F.when(inside[i], F.lit(i)).otherwise(at)
            part = F.when(inside[i], F.call_function("div", offset, F.lit(Decimal(width)))).otherwise(part)
        near = None
        for low, high in bounds:
            text = [str(Decimal(edge).scaleb(-scale, DIGITS)) for edge in (low, high)]
            within = column.between(*[F.lit(edge).cast(kind) for edge in text])
            near = within if near is None else near | within
        found = (
            stored.filter(near).select(at.alias("at"), part.alias("part"), units.alias("units"))
            .groupBy("at", "part").agg(F.count("*").alias("n"), F.sum("units").alias("units")).collect()
        )
        following = {}
        for i, (low, high) in enumerate(bounds):
            left, above, sum_above = open_at[low, high]
            for row in sorted((r for r in found if r["at"] == i), key=lambda r: -r["part"]):
                here = [n for n in left if above < n <= above + row["n"]]
                begin = low + row["part"] * widths[i]
                for n in here:
                    if n == above + row["n"]:
                        done[n] = sum_above + int(row["units"])
                    elif widths[i] == 1:
                        done[n] = sum_above + (n - above) * begin
                inner = [n for n in here if n not in done]
                if inner:
                    following[begin, begin + widths[i] - 1] = (inner, above, sum_above)
                above, sum_above = above + row["n"], sum_above + int(row["units"])
        open_at = following
    tables.discard(spark, path)
    return LargestValues(
        rows, seen["total"], {n: None if units is None else Decimal(units).scaleb(-scale, DIGITS) for n, units in done.items()}
    )
