"""What the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.sources import scratch, tables

# Words are runs of anything but the six ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows and bytes of an Arrow batch; a row may be larger than that.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
# Rows of a key and a digest, some 70 bytes each, that are broadcast at most.
BROADCAST_ROWS = 500_000
ROOT = str(Path(__file__).resolve().parents[2])
# monotonically_increasing_id keeps the partition above this bit.
PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """`frame` written to the shared folder and read back: its lineage ends there."""
    path = scratch.new_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    kept = frame.sparkSession.read.schema(frame.schema).parquet(path)
    kept._stored_at = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Remove what `stored` wrote for these frames; nothing may read them any more."""
    for frame in frames:
        tables.discard(frame.sparkSession, frame._stored_at)


def shipped(frame: DataFrame) -> DataFrame:
    """`frame`, ready for Python workers: they get small batches, so that texts of many rows never pile up.

    They are told where this package lies if they see the same folders; else ship it as py-files.
    """
    conf = frame.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    environment = frame.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [*paths, ROOT] if p)
    return frame


def text_digest(text: str) -> Column:
    """The digest of a text, null read as empty; beside its key what tells a row from others."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def without_rows(docs: DataFrame, gone: DataFrame, key: str, text: str) -> DataFrame:
    """`docs` but for rows with a key (null is one) and text that `gone` (key, digest) has.

    Few are broadcast; that they are few is counted.
    """
    few = gone.count() <= BROADCAST_ROWS
    g = gone.select(F.col("key").alias("_gone"), F.col("digest").alias("_digest"))
    same = F.col(key).eqNullSafe(F.col("_gone")) & (text_digest(text) == F.col("_digest"))
    return docs.join(F.broadcast(g) if few else g, same, "left_anti")


def tidied(work: Callable, at_end: Callable | None = None) -> Callable:
    """`work(batches)`, an iterator of Arrow batches, which leaves little behind when a task ends.

    Workers live on and later stages share an executor with them, so Arrow gives back what it
    holds free, and `at_end` drops what only this operator has a use for.
    """

    def run(batches):
        try:
            yield from work(batches)
        finally:
            if at_end:
                at_end()
            pa.default_memory_pool().release_unused()

    return run


def arrow_map(frame: DataFrame, work: Callable, schema: str, at_end: Callable | None = None) -> DataFrame:
    """`work(batch) -> pyarrow.RecordBatch` over every Arrow batch; `at_end()` as a task ends."""

    def run(batches):
        for batch in batches:
            yield work(batch)

    return shipped(frame).mapInArrow(tidied(run, at_end), schema)


def record_batch(fields: list[tuple[str, pa.DataType, object]]) -> pa.RecordBatch:
    """Columns given as (name, type, values) as one Arrow batch."""
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, kind) for _, kind, v in fields],
        schema=pa.schema([(name, kind) for name, kind, _ in fields]),
    )


def placed(frame: DataFrame, parts: int, order: list[Column], purpose: str) -> DataFrame:
    """`frame` range-sorted and stored, with `_part` and the row's `_place` in it.

    The sort is stored since its bounds are sampled: places and everything counted
    from them have to come from one and the same sort.
    """
    mask = F.lit((1 << PLACE_BITS) - 1)
    return stored(
        frame.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_id", PLACE_BITS), "_place": F.col("_id").bitwiseAND(mask)})
        .drop("_id"),
        purpose,
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_offsets(rows: DataFrame, group: str, per_part: Column) -> DataFrame:
    """For each (`group`, `_part`) of placed rows: `_before`, the sum of `per_part` in earlier parts, and `_first`.

    One row for each group and partition that meet: of a range sort by `group`
    first, at most the partitions plus the groups.
    """
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(group, "_part")
        .agg(per_part.alias("_sum"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("long")))
    )
