"""Daily order files as raw rows: fields by header name, whatever a file's column order."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.sources import scratch, tables

# A field is plain or quoted text; what follows the last one of the header is drift if it holds any sign
# but commas, quotes and blanks. All repeats are possessive, so a line is read once, however long.
SURPLUS = '^(?:(?:[^",]++|"[^"]*+")*+,){%d}[,"\\s]*+[^,"\\s]'


def surplus_line(line: Column, fields: int = len(schemas.ORDER_FIELDS)) -> Column:
    """The line, if it carries a value past the fields of its header; else null."""
    return F.when(line.rlike(SURPLUS % fields), line)


def read_order_files(
    spark: SparkSession,
    inbox: str,
    pattern: str = "orders_*.csv",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the lines of new order files, with the file and the block they lie in."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(inbox).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def file_headers(lines: DataFrame) -> DataFrame:
    """The first line of every file."""
    first = lines.filter("_block = 0").withColumn("_at", F.monotonically_increasing_id())
    return first.groupBy("_path").agg(F.min_by("value", "_at").alias("_header"))


def header_names(header: str) -> list[str]:
    return [name.strip().lower() for name in next(csv.reader([header.lstrip("\ufeff")]))]


def by_header(lines: DataFrame, header: str) -> DataFrame:
    """Raw order rows from lines that share one header.

    A declared field that the header does not name is null. A line with a value
    under a name that is not declared, or past the last name, is kept as a whole
    in `_rescued_data`. Blank lines are no rows, nor is a header that is repeated.
    """
    names = header_names(header)
    places = {name: i for i, name in reversed(list(enumerate(names)))}
    rows = lines.filter((F.col("value") != header) & (F.trim("value") != "")).withColumn(
        "_f", F.from_csv("value", ", ".join(f"_{i} STRING" for i in range(len(names))))
    )
    unknown = [F.trim(F.col(f"_f._{i}")) != "" for i, name in enumerate(names) if places[name] != i or name not in schemas.ORDER_FIELDS]
    rescued = surplus_line(F.col("value"), len(names))
    if unknown:
        rescued = F.when(reduce(Column.__or__, [F.coalesce(u, F.lit(False)) for u in unknown]), F.col("value")).otherwise(rescued)
    none = F.lit(None).cast("string")
    return rows.select(
        *[(F.col(f"_f._{places[name]}") if name in places else none).alias(name) for name in schemas.ORDER_FIELDS],
        rescued.alias("_rescued_data"),
        "_source_file",
        F.current_timestamp().alias("_ingested_at"),
    )


def order_rows(lines: DataFrame) -> tuple[DataFrame, str]:
    """Raw order rows of a batch of lines, and the work folder they are read from.

    Files are grouped by their header; only the distinct headers go to the driver.
    """
    spark, work = lines.sparkSession, scratch.new_dir(lines.sparkSession, "headers")
    file_headers(lines).write.parquet(work)
    headers = spark.read.schema("_path STRING, _header STRING").parquet(work)
    found = [row[0] for row in headers.select("_header").distinct().collect()]
    parts = [by_header(lines.join(headers.filter(F.col("_header") == h), "_path", "left_semi"), h) for h in found]
    empty = spark.createDataFrame([], schemas.BRONZE_ORDERS)
    return reduce(DataFrame.unionByName, parts, empty), work


def write_batch(lines: DataFrame, folder: str) -> None:
    """Write the order rows of a batch of lines; writing a batch again replaces it."""
    rows, work = order_rows(lines)
    tables.conform(rows, schemas.BRONZE_ORDERS).write.mode("overwrite").option("compression", tables.CODEC).parquet(folder)
    tables.discard(lines.sparkSession, work)
