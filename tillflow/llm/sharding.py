"""Shards of near equal bytes by histogram sort.

Rows are ordered by a key of 60 bits: 40 from the text, so that equal texts lie
together, then 20 from the row's id, so that a huge group of copies can still be
cut. Splitters are found by counting: every round counts the exact bytes below
evenly spaced probes inside the intervals that still hold a splitter, and a
splitter is done when a probe meets its target within the tolerance. Only then do
the rows move, once, to a range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import partitions, placed, stored, with_offsets

# Bits of the key, and bits that one round refines.
KEY_BITS, ROW_BITS, STEP_BITS = 60, 20, 10
# Part of a shard's bytes by which a splitter may miss its target.
TOLERANCE = 0.002
ROW_OVERHEAD = 8


def size_of(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus the row's overhead."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_OVERHEAD


def sort_key(key: str, text: str) -> Column:
    of_text = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 64 - KEY_BITS + ROW_BITS)
    of_row = F.xxhash64(F.col(key)).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return F.shiftleft(of_text, ROW_BITS).bitwiseOR(of_row)


def splitters(slim: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """Keys at which shards 1, 2, … begin; from `k` and `size` of every row.

    A round gathers at most (shards - 1) * 2**STEP_BITS sums. The intervals of a
    round are 2**shift wide and start at multiples of it.
    """
    shift = KEY_BITS - STEP_BITS
    probe = F.shiftright("k", shift)
    sums = dict(slim.groupBy(probe.alias("p")).agg(F.sum("size")).collect())
    total = sum(sums.values())
    if not total:
        return [1 << KEY_BITS] * (shards - 1)
    targets = [total * i / shards for i in range(1, shards)]
    slack = tolerance * total / shards
    found: dict[int, int] = {}
    # Per open interval (its probe number one round up): bytes below it, and the sums inside.
    intervals = {None: (0, sums)}
    open_at = {i: None for i in range(shards - 1)}
    while open_at:
        inside: dict[int, int | None] = {}
        below_of: dict[int, int] = {}
        for parent, (below, counts) in intervals.items():
            mine = sorted(i for i, at in open_at.items() if at == parent)
            for p in sorted(counts):
                end = below + counts[p]
                while mine and targets[mine[0]] < end:
                    i = mine.pop(0)
                    low, high = targets[i] - below, end - targets[i]
                    if min(low, high) <= slack or shift == 0:
                        found[i] = (p if low <= high else p + 1) << shift
                    else:
                        inside[i], below_of[p] = p, below
                below = end
            for i in mine:  # a target that rounds to the very end
                found[i] = (max(counts) + 1) << shift
        open_at = inside
        if not open_at:
            break
        wanted, shift = sorted(set(inside.values())), max(0, shift - STEP_BITS)
        rows = (
            slim.filter(F.shiftright("k", shift + STEP_BITS).isin(wanted))
            .groupBy(F.shiftright("k", shift).alias("p")).agg(F.sum("size")).collect()
        )
        intervals = {p: (below_of[p], {q: s for q, s in rows if q >> STEP_BITS == p}) for p in wanted}
    return sorted(found[i] for i in range(shards - 1))


def shard_of(cuts: list[int]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("k") >= F.lit(cut)).cast("int")
    return shard


def assign_shards(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard and slot (0, 1, … inside the shard) of every row of `docs`.

    Shards hold near equal bytes: a splitter misses its target by at most
    TOLERANCE of a shard, or by half of the row it falls on. Equal texts share a
    shard unless a splitter has to fall inside their group. A null text counts as
    no bytes; rows equal in id and text stay together and take any order; an empty
    table gives an empty result; further columns are not read.
    """
    slim = stored(docs.select(
        F.col(key).alias("key"), size_of(text).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"), sort_key(key, text).alias("k"),
    ), "shard-rows")
    cut = slim.withColumn("shard", shard_of(splitters(slim, shards)))
    parts = max(shards, partitions(docs.sparkSession))
    order = [F.col("shard"), F.col("k"), F.col("key")]
    rows = placed(cut, parts, order, "shard-sorted")
    # At most one row for each partition and for each shard.
    offsets = with_offsets(rows, "shard", F.count("*"))
    return rows.join(F.broadcast(offsets), ["shard", "_part"]).select(
        "key", "size", "text_crc32", "shard", (F.col("_before") + F.col("_place") - F.col("_first")).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id", text: str = "text") -> None:
    """The rows of `docs` below `path`, a folder for each shard, in key order; one exchange of the full rows."""
    slim = docs.select(size_of(text).alias("size"), sort_key(key, text).alias("k"))
    cuts = splitters(stored(slim, "shard-rows"), shards)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    (
        docs.select(sort_key(key, text).alias("k"), row).withColumn("shard", shard_of(cuts))
        .repartitionByRange(max(shards, partitions(docs.sparkSession)), "shard", "k").sortWithinPartitions("shard", "k")
        .select("row", "shard").write.partitionBy("shard").parquet(path)
    )
