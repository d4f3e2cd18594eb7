"""Mixing sources to target weights, block by block.

Each source's words are packed into blocks of `block_words`; only its last block
may be short. A source takes its whole passes over all its blocks and then, for
what is left of its target, slots of one more pass, the last one cut to the word.
Slots are mapped to blocks through a pseudorandom permutation of each source's
block numbers, and joined with the blocks by number. Output shards have a fixed
number of slots; their source counts are the multinomial draw, conditioned on
every source's total: a permutation of all slots deals them out. (Free draws
would miss the targets of small sources and could pass three times their size.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import WORD, partitions, placed, stored, with_offsets

BLOCK_WORDS = 256
WEIGHTS = 3
MOST_PASSES = 3
OUT_SHARDS = 64
SEED = 20261
# Rounds of the swap-or-not shuffle; rows in a bucket of a source's axis; slots dealt out by one row.
ROUNDS = 24
BUCKET_ROWS = 256
SUPER_BUCKETS = 1024
SLOT_CHUNK = 4096
# Parts of one copy that shares are counted in.
SHARE = 1 << 20


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, size: Column, *keys: Column) -> Column:
    """`index` under a keyed permutation of 0 … size - 1.

    Swap-or-not: in each round `x` and its mirror image `m - x` are swapped or
    not, by a hash of the larger. It is a permutation for every size, so nothing
    has to be walked until it falls inside.
    """

    def turn(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), *keys, r), size) - x, size)
        swap = F.xxhash64(F.lit(SEED + 1), *keys, r, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def source_targets(slim: DataFrame) -> DataFrame:
    """source, source_no (0, 1, … by code point, null last), source_size, weight, target; one row for each source.

    All sizes are shared by weight; a target stops at MOST_PASSES times its
    source's size and the excess is shared again by weight until none is above.
    Sums of two numbers go to the driver in each round.
    """
    spark = slim.sparkSession
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = placed(sums, partitions(spark), [F.col("source").isNull(), F.col("source")], "mix-sources")
    rows = rows.withColumn("_all", F.lit(0))
    offsets = with_offsets(rows, "_all", F.count("*"))
    numbered = stored(
        rows.join(F.broadcast(offsets), ["_all", "_part"])
        .withColumn("source_no", F.col("_before") + F.col("_place"))
        .select("source", "source_no", "source_size", (F.col("source_no") % WEIGHTS + 1).alias("weight")),
        "mix-numbered",
    )
    most = F.col("source_size") * MOST_PASSES
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    share, capped = None, -1
    while True:
        above = F.lit(False) if share is None else F.col("weight") * F.lit(share) > most
        row = numbered.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count_if(above).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["weights"]:
            break
        capped, share = row["capped"], (total - row["taken"]) / row["weights"]
    target = F.least(F.col("weight") * F.lit(float(share or 0.0)), most.cast("double"))
    return numbered.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(target))


def on_axis(slim: DataFrame, rows: int) -> DataFrame:
    """`slim` with `start`: where the row begins on its source's axis of words.

    Rows are summed up inside hashed buckets, buckets inside larger ones, and
    those inside the source, so that a hot source is never one task.
    """
    buckets = max(1, rows // BUCKET_ROWS)
    slim = slim.withColumn("_bucket", F.pmod(F.xxhash64("key", "size"), F.lit(buckets)))
    before = [Window.unboundedPreceding, -1]
    inside = Window.partitionBy("source_no", "_bucket").orderBy("key", "size").rowsBetween(*before)
    among = Window.partitionBy("source_no", "_super").orderBy("_bucket").rowsBetween(*before)
    supers = Window.partitionBy("source_no").orderBy("_super").rowsBetween(*before)
    zero = F.lit(0).cast("long")
    sums = (
        slim.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_sum"))
        .withColumn("_super", F.floor(F.col("_bucket") / SUPER_BUCKETS))
    )
    higher = (
        sums.groupBy("source_no", "_super").agg(F.sum("_sum").alias("_all"))
        .select("source_no", "_super", F.coalesce(F.sum("_all").over(supers), zero).alias("_higher"))
    )
    offsets = (
        sums.withColumn("_lower", F.coalesce(F.sum("_sum").over(among), zero)).join(higher, ["source_no", "_super"])
        .select("source_no", "_bucket", (F.col("_lower") + F.col("_higher")).alias("_offset"))
    )
    return (
        slim.withColumn("_inside", F.coalesce(F.sum("size").over(inside), zero))
        .join(offsets, ["source_no", "_bucket"])
        .withColumn("start", F.col("_inside") + F.col("_offset")).drop("_inside", "_offset", "_bucket")
    )


def slots(sources: DataFrame, block_words: int, out_shards: int) -> DataFrame:
    """One row for each block that the mix takes: source_no, pass, block, words, shard, place."""
    want = F.floor("target").cast("long")
    plan = sources.filter("source_size > 0").select(
        "source_no", "source_size", F.col("source_size").alias("n"), want.alias("want"),
    ).withColumns({
        "blocks": F.ceil(F.col("n") / block_words).cast("long"),
        "full": F.floor(F.col("n") / block_words).cast("long"),
        "passes": F.floor(F.col("want") / F.col("n")).cast("long"),
    }).withColumn("rest", F.col("want") - F.col("passes") * F.col("n"))
    plan = plan.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
    plan = stored(plan.filter("slots > 0"), "mix-plan")
    total = plan.agg(F.sum("slots")).first()[0] or 0
    earlier = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each source: their number, not their size, is what this window sorts.
    plan = plan.withColumn("first_slot", F.coalesce(F.sum("slots").over(earlier), F.lit(0)))
    parts = partitions(sources.sparkSession)
    dealt = (
        plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SLOT_CHUNK))))
        .repartition(parts, "source_no", "chunk")
        .withColumn("slot", F.explode(F.sequence(
            F.col("chunk") * SLOT_CHUNK, F.least((F.col("chunk") + 1) * SLOT_CHUNK, F.col("slots")) - 1,
        )))
        .withColumns({"pass": F.floor(F.col("slot") / F.col("blocks")), "turn": F.pmod("slot", "blocks")})
    )
    # The short block keeps its number, the last; the others are permuted afresh in every pass.
    block = F.when(
        F.col("turn") < F.col("full"),
        permuted(F.col("turn"), F.greatest("full", F.lit(1)), F.col("source_no"), F.col("pass")),
    ).otherwise(F.col("turn"))
    length = F.when(F.col("turn") < F.col("full"), F.lit(block_words)).otherwise(F.col("n") - F.col("full") * block_words)
    left = F.col("rest") - F.col("turn") * block_words
    words = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, left))
    dealt = dealt.withColumns({
        "block": block, "words": words.cast("long"),
        "at": permuted(F.col("first_slot") + F.col("slot"), F.lit(max(total, 1)), F.lit(-1)),
    })
    per_shard = -(-max(total, 1) // out_shards)
    return dealt.select(
        "source_no", "pass", "block", "words",
        F.floor(F.col("at") / per_shard).cast("int").alias("shard"), F.pmod("at", F.lit(per_shard)).alias("place"),
    )


@dataclass
class Mix:
    """sources: source_targets; pieces: what each slot takes of each row; documents: taken words of every row."""

    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame
    documents: DataFrame

    def shard_counts(self) -> DataFrame:
        """How many blocks of each source each output shard drew."""
        return self.slots.groupBy("shard", "source_no").count()


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    block_words: int = BLOCK_WORDS, out_shards: int = OUT_SHARDS,
) -> Mix:
    """A mix of `docs` by source; nothing is random but for the fixed seed, so reruns agree.

    Sizes count words. A null text has none; a null source is a source, the last
    one; rows without words are taken 0 times; repeated rows are rows of their own
    and share alike; an empty table gives empty results; further columns are not
    read. Nothing is taken more than MOST_PASSES times.
    """
    slim = stored(docs.select(
        F.col(key).alias("key"), word_count(text).alias("size"), F.col(source).cast("string").alias("source"),
        F.monotonically_increasing_id().alias("row_no"),  # rows without words share their place on the axis
    ), "mix-rows")
    sources = stored(source_targets(slim), "mix-targets")
    same = slim["source"].eqNullSafe(sources["source"])
    known = slim.join(sources.select("source", "source_no", "source_size", "target"), same).drop(sources["source"])
    rows = on_axis(known, slim.count())
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    segments = rows.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    taken = stored(slots(sources, block_words, out_shards), "mix-slots")
    found = segments.join(taken, ["source_no", "block"], "left")
    begin = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.col("words"))
    took = F.when(F.col("words").isNull(), F.lit(0)).otherwise(F.greatest(end - begin, F.lit(0)))
    pieces = found.withColumns({"begin": begin, "took": took.cast("long")})
    documents = pieces.groupBy("row_no", "key", "source_no", "start", "size", "source_size", "target").agg(
        F.coalesce(F.sum("took"), F.lit(0)).cast("long").alias("taken")
    ).drop("row_no")
    return Mix(sources, taken, pieces, documents)


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`docs` as the mix has them: a row as often as it is taken, whole.

    A row's taken words over its size are its share of copies. Shares are added up
    along each source, the smallest rows first, and a row's copies are the whole
    numbers that it passes: since sizes never fall, a source misses its target by
    less than its largest key. Rows without words and rows with a null key stay once;
    rows of one key share their copies alike, and count for the first of their sources.
    """
    mixed = mix(docs.filter(F.col(key).isNotNull()), key, text, source).documents
    keys = mixed.groupBy("key").agg(
        F.min("source_no").alias("source_no"), F.sum("size").alias("size"), F.sum("taken").alias("taken"),
    )
    parts = partitions(docs.sparkSession)
    share = F.round(F.col("taken") * SHARE / F.col("size")).cast("long")  # whole numbers, so that sums are exact
    rows = placed(
        keys.filter("size > 0").withColumn("share", share), parts,
        [F.col("source_no"), F.col("size"), F.col("key")], "mix-shares",
    )
    offsets = with_offsets(rows, "source_no", F.sum("share")).select("source_no", "_part", "_before")
    here = Window.partitionBy("source_no", "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_here", F.sum("share").over(here)).join(offsets, ["source_no", "_part"])
    # From one half on, so that the miss is shared by both sides.
    end = F.col("_before") + F.col("_here") + SHARE // 2
    passed = F.floor(end / SHARE) - F.floor((end - F.col("share")) / SHARE)
    copies = summed.select("key", passed.cast("int").alias("copies"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = docs.select(F.col(key).alias("key"), row).join(copies, "key", "left")
    each = F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("copies"), F.lit(1))))
    return found.select("row", each.alias("copy")).select("row.*")
