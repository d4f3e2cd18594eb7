"""Exact dedup with the heavy hitters taken out of the shuffle.

A frequent-items sketch, a Misra-Gries summary that every task fills for its own
rows and that merges in two steps, names the digests that may be frequent. Those
are counted exactly; the verified ones, at most `HEAVY_ITEMS`, are broadcast and
their rows decided where they lie. All other digests go through an ordinary
shuffle by digest, in which no group holds more than a small share of the rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import stored

# Bounds of the sketch: counters kept for each summary, and digests broadcast at most.
SKETCH_ITEMS = 4096
HEAVY_ITEMS = 256
# Summaries merge inside this many groups first, so that no task merges one for every task.
MERGE_GROUPS = 64
# What is known of frequent digests. Made as Arrow in the driver, it asks executors for no Python workers to unpack it.
WINNERS = pa.schema([("digest", pa.string()), ("keep", pa.int64()), ("size", pa.int64()), ("ties", pa.int64())])


def digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"))


def heavy_winners(slim: DataFrame) -> DataFrame:
    """Digest, keep, size and ties (rows that carry the kept key) of frequent digests; at most HEAVY_ITEMS rows.

    The sketch may name rare digests too: each is counted exactly, and the ones
    that occur once stay in the shuffle. Missing one costs speed, not rows.
    """
    spark = slim.sparkSession
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    sketch = (
        slim.groupBy(group.alias("g")).agg(F.expr(f"approx_top_k_accumulate(digest, {SKETCH_ITEMS})").alias("s"))
        .groupBy(F.pmod("g", F.lit(1)))  # a grouping, since an empty task's summary of no type cannot be merged
        .agg(F.expr(f"approx_top_k_combine(s, {SKETCH_ITEMS})").alias("s"))
        .select(F.expr(f"approx_top_k_estimate(s, {HEAVY_ITEMS})").alias("top"))
    )
    named = [item["item"] for row in sketch.collect() for item in (row["top"] or []) if item["count"] > 1]
    if not named:
        return spark.createDataFrame(WINNERS.empty_table())
    counted = {
        row["digest"]: row
        for row in slim.filter(F.col("digest").isin(named)).groupBy("digest")
        .agg(F.max("key").alias("keep"), F.count("*").alias("size")).collect() if row["size"] > 1
    }
    if not counted:
        return spark.createDataFrame(WINNERS.empty_table())
    best = [{"digest": d, "keep": r["keep"]} for d, r in counted.items()]
    best = spark.createDataFrame(pa.Table.from_pylist(best, WINNERS)).select("digest", "keep")
    ties = (
        slim.join(F.broadcast(best), "digest").filter(F.col("key").eqNullSafe(F.col("keep")))
        .groupBy("digest").count().collect()
    )
    rows = [
        {"digest": t["digest"], "keep": counted[t["digest"]]["keep"], "size": counted[t["digest"]]["size"], "ties": t["count"]} for t in ties
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, WINNERS))


def decide(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """`rows` (key, digest and any others) with `keep_id`, `group_size` and `kept`."""
    out = [*rows.columns, "keep_id", "group_size", "kept"]
    known = rows.join(F.broadcast(winners), "digest", "left")
    is_top = F.col("key").eqNullSafe(F.col("keep"))
    heavy = known.filter("size IS NOT NULL")
    plain = (
        heavy.filter(~is_top | (F.col("ties") == 1))
        .withColumns({"keep_id": F.col("keep"), "group_size": F.col("size"), "kept": is_top}).select(out)
    )
    group = Window.partitionBy("digest")
    light = known.filter("size IS NULL").withColumns({
        "keep_id": F.max("key").over(group), "group_size": F.count("*").over(group),
        "kept": F.row_number().over(group.orderBy(F.desc_nulls_last("key"))) == 1,
    }).select(out)
    result = plain.unionByName(light)
    if winners.filter("ties > 1").isEmpty():
        return result
    # A frequent text whose kept key is repeated: one row of each task first, then one of those.
    local = Window.partitionBy("digest", "_task").orderBy("key")
    first = Window.partitionBy("digest", "_left").orderBy("_task")
    tied = (
        heavy.filter(is_top & (F.col("ties") > 1)).withColumn("_task", F.spark_partition_id())
        .withColumn("_lead", F.row_number().over(local) == 1)
        .withColumn("_left", F.when(F.col("_lead"), F.lit(-1)).otherwise(F.col("_task")))
        .withColumns({
            "keep_id": F.col("keep"), "group_size": F.col("size"),
            "kept": F.col("_lead") & (F.row_number().over(first) == 1),
        }).select(out)
    )
    return result.unionByName(tied)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: key, digest, keep_id, group_size, kept.

    Texts are equal when identical after no change; a null text counts as empty.
    Of equal texts exactly one row is kept: the one with the largest key, any one
    of them if that key is repeated; null keys rank lowest. An empty table gives
    an empty result; further columns of `docs` are not read, whatever their names.
    """
    slim = stored(digests(docs, key, text), "exact-digests")
    return decide(slim, heavy_winners(slim))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that exact_dedup keeps, with the columns of `docs`."""
    slim = stored(digests(docs, key, text), "exact-digests")
    rows = docs.select(
        F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    return decide(rows, heavy_winners(slim)).filter("kept").select("row.*")
