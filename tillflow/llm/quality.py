"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model's signs are all characters as they are, blanks in a row as one; its
n-grams are counted with no fixed alphabet, so that their number grows with the
data. An n-gram is two numbers: `lo` has its last three signs, `hi` those before.
Every task counts the n-grams of its documents, the trusted ones apart; Spark adds
them up by n-gram. The counts of each order are then joined with those of their
contexts and of the next lower order, sharded by n-gram, which gives a
probability to every n-gram that any document holds. Documents are stored in blocks;
the distinct n-grams of each block are joined with the probabilities, and these move to
where the block's texts lie, in a table bucketed by block. Texts fall into two halves by a hash, and each half is
scored by the model of the other's trusted texts: so many n-grams would know the
texts that they were counted in. A document's perplexity is the mean over its
n-grams. A document is rejected if it is less likely than a quantile of the trusted documents
of its language allows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import PLACE_BITS, discard, partitions, record_batch, shipped, stored, tidied, without_rows
from tillflow.sources import scratch

ORDER = 4
# A sign is a code point; so many bits hold one, and LO_SIGNS of them fit one number.
SIGN_BITS, LO_SIGNS = 21, 3
SIGNS, CODES = 1 << SIGN_BITS, 0x110000
# The quantile of trusted documents up to which all are kept.
QUANTILE = 0.99
# A document counts as so many signs of its language's median more; bins of a unit of log perplexity.
PRIOR_SIGNS, BINS = 40, 1000
# Discounts where n-grams of one to three occurrences are too few to estimate them from.
FEW_COUNTS = [0.5, 0.75, 0.9]
# Signs that a worker takes at a time, bytes of texts in a block, and ids that are broadcast at most.
SLICE_SIGNS = 400_000
BLOCK_BYTES = 12_000_000
BROADCAST_KEYS = 1_000_000
BLANK = ord(" ")

_blanks: list[np.ndarray] = []


def slices(texts: list[str | None]):
    """(signs, where n-grams begin in them, number of the text of each) of slices of texts.

    Blanks in a row are one, and ORDER - 1 stand before a text.
    """
    if not _blanks:
        _blanks.append(np.array([chr(c).isspace() for c in range(CODES)]))
    parts, begins, owners, length, grams_held = [], [], [], 0, 0
    for number, text in enumerate(texts):
        signs = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.int32)
        blank = _blanks[0][signs]
        if blank.all():
            continue
        signs[blank] = BLANK
        signs = signs[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        signs = np.concatenate([np.full(ORDER - 1, BLANK, np.int32), signs])
        for begin in range(0, len(signs) - ORDER + 1, SLICE_SIGNS):
            piece = signs[begin : begin + SLICE_SIGNS + ORDER - 1]
            found = len(piece) - ORDER + 1
            parts.append(piece)
            begins.append(np.arange(length, length + found))
            owners.append(np.full(found, number))
            length, grams_held = length + len(piece), grams_held + found
            if grams_held >= SLICE_SIGNS:
                yield np.concatenate(parts), np.concatenate(begins), np.concatenate(owners)
                parts, begins, owners, length, grams_held = [], [], [], 0, 0
    if parts:
        yield np.concatenate(parts), np.concatenate(begins), np.concatenate(owners)


def ranked(signs: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A number for each n-gram, the same for the same n-gram and for no other in this slice."""
    present = np.zeros(CODES, bool)
    present[signs] = True
    ids = (np.cumsum(present) - 1)[signs]
    width = alphabet = int(present.sum())
    found = ids[begins]
    for i in range(1, ORDER):
        if width * alphabet >= 1 << 62:
            distinct, found = np.unique(found, return_inverse=True)
            width = len(distinct)
        found = found * alphabet + ids[begins + i]
        width *= alphabet
    return found


def paired(signs: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """hi and lo of the n-grams that begin at `begins`."""
    halves = [np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)]
    for i in range(ORDER):
        half = int(i >= ORDER - LO_SIGNS)
        halves[half] = (halves[half] << SIGN_BITS) | signs[begins + i]
    return halves[0], halves[1]


def grams(texts: list[str | None]):
    """(n-grams as whole numbers to the base SIGNS, number of the text) of slices of texts."""
    for signs, begins, owners in slices(texts):
        hi, lo = paired(signs, begins)
        yield (hi.astype(object) << (SIGN_BITS * LO_SIGNS)) | lo.astype(object), owners


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def in_blocks(docs: DataFrame) -> DataFrame:
    """`docs` (key, text, trusted, lang) and the half of each, stored as block and `rows`, packed rows of that block.

    Blocks are neighbours of BLOCK_BYTES, whatever their keys. Their table is bucketed by
    block, so that what is joined to them later moves, and the texts stay. `finished`
    drops it.
    """

    def work(batches):
        block, held = TaskContext.get().partitionId() << PLACE_BITS, 0
        for batch in batches:
            numbers, cuts = [], [0]
            for at, size in enumerate(batch.column(5).to_pylist()):
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                    cuts.append(at)
                held += size
                numbers.append(block)
            kept = pa.RecordBatch.from_arrays(batch.columns[:5], names=["key", "text", "trusted", "lang", "half"])
            for begin, end in zip(cuts, [*cuts[1:], len(numbers)]):
                if begin < end:
                    rows = [packed(kept.slice(begin, end - begin))]
                    yield record_batch([("block", pa.int64(), [numbers[begin]]), ("rows", pa.binary(), rows)])

    half = F.xxhash64("text").bitwiseAND(F.lit(1)).alias("half")
    rows = docs.select("key", "text", "trusted", "lang", half, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    blocks = shipped(rows).mapInArrow(tidied(work), "block long, rows binary")
    path, name = scratch.new_dir(docs.sparkSession, "lm-blocks"), f"lm_blocks_{uuid.uuid4().hex}"
    blocks.write.bucketBy(partitions(docs.sparkSession), "block").option("path", path).saveAsTable(name)
    found = docs.sparkSession.table(name)
    found._stored_at, found._table_name = path, name
    return found


def finished(blocks: DataFrame) -> None:
    blocks.sparkSession.sql(f"DROP TABLE {blocks._table_name}")
    discard(blocks)


def block_grams(blocks: DataFrame) -> DataFrame:
    """block, hi, lo, c0 and c1 of the n-grams of `blocks`; each task adds a block's slices up.

    c0 counts for the model that scores half 0, in trusted documents of half 1; c1 the other way round.
    """

    def work(batches):
        now, held = None, []
        for block, texts, counted in runs(batches):
            if block != now and held:
                yield summed(now, held)
                held = []
            now = block
            for signs, begins, owners in slices(texts):
                codes = ranked(signs, begins)
                order = np.argsort(codes)
                codes = codes[order]
                firsts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
                counts = [np.add.reduceat((counted == m)[owners[order]].astype(np.int64), firsts) for m in range(2)]
                held.append((*paired(signs, begins[order[firsts]]), *counts))
        if held:
            yield summed(now, held)

    def summed(block, held):
        frame = pd.DataFrame({c: np.concatenate(v) for c, v in zip(("hi", "lo", "c0", "c1"), zip(*held))})
        if len(held) > 1:
            frame = frame.groupby(["hi", "lo"], as_index=False).sum()
        columns = [(c, pa.int64(), frame[c].to_numpy()) for c in ("hi", "lo", "c0", "c1")]
        return record_batch([("block", pa.int64(), np.full(len(frame), block)), *columns])

    def runs(batches):
        """Texts of one block, SLICE_SIGNS bytes or so at a time, each with the model that it counts for, or -1."""
        now, texts, counted, held = None, [], [], 0
        for block, data in ((b, d) for batch in batches for b, d in zip(batch.column(0).to_pylist(), batch.column(1))):
            rows = unpacked(data.as_buffer())
            for text, trusted, half in zip(*(rows.column(c).to_pylist() for c in ("text", "trusted", "half"))):
                if texts and (block != now or held >= SLICE_SIGNS):
                    yield now, texts, np.array(counted)
                    texts, counted, held = [], [], 0
                now, held = block, held + len(text or "")
                texts.append(text)
                counted.append(1 - half if trusted else -1)
        if texts:
            yield now, texts, np.array(counted)

    return shipped(blocks).select("block", "rows").mapInArrow(tidied(work), "block long, hi long, lo long, c0 long, c1 long")


def gram_counts(docs: DataFrame) -> DataFrame:
    """hi, lo, c (in trusted documents) of every n-gram in `docs` (key, text, trusted, lang)."""
    return block_grams(in_blocks(docs)).groupBy("hi", "lo").agg(F.sum(F.col("c0") + F.col("c1")).alias("c"))


def discounts(counts: DataFrame, c: str) -> list[float]:
    """D1, D2 and D3+ from how many n-grams occur one to four times; FEW_COUNTS if none occurs once, twice or three times."""
    n = {r[c]: r["n"] for r in counts.filter(F.col(c).between(1, 4)).groupBy(c).agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    if not (n1 and n2 and n3):
        return FEW_COUNTS
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), k - 0.05) for k, d in zip((1, 2, 3), found)]


def _discount(d: list[float], c: str) -> Column:
    return F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])


def _last(order: int) -> list[Column]:
    """hi and lo of an n-gram's last `order` signs."""
    mask = [(1 << SIGN_BITS * n) - 1 for n in (max(0, order - LO_SIGNS), min(order, LO_SIGNS))]
    return [F.col(c).bitwiseAND(F.lit(m).cast("long")) for c, m in zip(("hi", "lo"), mask)]


def probabilities(counts: DataFrame, models: tuple[str, ...] = ("",)) -> DataFrame:
    """hi, lo and logp of every n-gram of `counts` (hi, lo, c): interpolated modified Kneser-Ney.

    Lower orders count the different signs before an n-gram. Contexts that were
    never trusted fall back to the next lower order. Several models, whose columns
    end as given, go through the same joins.
    """
    p = None
    # Every n-gram of an order that needs a probability, with what it counts: 0 if never trusted.
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        hi, lo = _last(order)
        different = [F.count_if(F.col(f"c{m}") > 0).cast("long").alias(f"c{m}") for m in models]
        levels.append(stored(levels[-1].groupBy(hi.alias("hi"), lo.alias("lo")).agg(*different), "lm-counts"))
    # The signs of the context: all but the last one.
    carry = F.shiftleft(F.col("hi").bitwiseAND(F.lit(SIGNS - 1).cast("long")), SIGN_BITS * (LO_SIGNS - 1))
    context = [F.shiftright("hi", SIGN_BITS).alias("h_hi"), F.shiftright("lo", SIGN_BITS).bitwiseOR(carry).alias("h_lo")]
    for order, level in enumerate(reversed(levels), start=1):
        d = {m: discounts(level, f"c{m}") for m in models}
        contexts = level.groupBy(*context).agg(
            *[F.sum(f"c{m}").alias(f"total{m}") for m in models],
            *[F.sum(_discount(d[m], f"c{m}")).alias(f"left{m}") for m in models],
        )
        lower_hi, lower_lo = _last(order - 1)
        joined = level.select("*", *context, lower_hi.alias("l_hi"), lower_lo.alias("l_lo")).join(contexts, ["h_hi", "h_lo"])
        if p is not None:
            known = p.select(F.col("hi").alias("l_hi"), F.col("lo").alias("l_lo"), *[F.col(f"p{m}").alias(f"q{m}") for m in models])
            joined = joined.join(known, ["l_hi", "l_lo"])
        lower = {m: F.lit(1.0 / SIGNS) if p is None else F.col(f"q{m}") for m in models}
        found = joined.select("hi", "lo", *[
            F.when(F.col(f"total{m}") == 0, lower[m]).otherwise(
                (F.col(f"c{m}") - _discount(d[m], f"c{m}") + F.col(f"left{m}") * lower[m]) / F.col(f"total{m}")
            ).alias(f"p{m}") for m in models
        ])
        below, p = p, stored(found, "lm-probabilities")
        discard(*([below] if below is not None else []), *([level] if order < ORDER else []))
    found = p.select("hi", "lo", *[F.log(f"p{m}").cast("float").alias(f"logp{m}") for m in models])
    found._stored_at = p._stored_at
    return found


def scored(docs: DataFrame, table: DataFrame) -> DataFrame:
    """`docs` (key, text, trusted, lang) without the text: key, digest, trusted, lang, signs, logp (sum)."""
    blocks = in_blocks(docs)
    known = block_grams(blocks).join(table, ["hi", "lo"])
    return scored_blocks(blocks, known.select("block", "hi", "lo", F.col("logp").alias("logp0"), F.col("logp").alias("logp1")))


def scored_blocks(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Every block's texts, each half with the probabilities that `known` (block, hi, lo, logp0, logp1) has for it."""

    def work(rows: pa.Table, known: pa.Table) -> pa.Table:
        table = pd.DataFrame({c: known.column(c).to_numpy() for c in known.column_names if c != "block"}).drop_duplicates(["hi", "lo"])
        rows = pa.concat_tables([unpacked(data.as_buffer()) for data in rows.column("rows")])
        texts, half = rows.column("text").to_pylist(), rows.column("half").to_numpy()
        signs, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for found, begins, owners in slices(texts):
            _, first, at = np.unique(ranked(found, begins), return_index=True, return_inverse=True)
            hi, lo = paired(found, begins[first])
            found = pd.DataFrame({"hi": hi, "lo": lo}).merge(table, "left", ["hi", "lo"])[["logp0", "logp1"]].to_numpy(np.float64)
            signs += np.bincount(owners, minlength=len(texts))
            total += np.bincount(owners, found[at, half[owners]], minlength=len(texts))
        digests = [hashlib.sha256((text or "").encode()).digest() for text in texts]
        return pa.table({
            "key": rows.column("key"), "digest": pa.array(digests, pa.binary()), "trusted": rows.column("trusted"), "lang": rows.column("lang"),
            "signs": pa.array(signs, pa.int64()), "logp": pa.array(total, pa.float64()),
        })

    schema = "key long, digest binary, trusted boolean, lang string, signs long, logp double"
    return shipped(blocks).groupBy("block").cogroup(known.groupBy("block")).applyInArrow(work, schema)


def _quantile(values: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """For each language, and all of them as `_all`, the upper edge of the bin that holds each share; exact on bins."""
    every = Window.partitionBy("lang", "_all")
    up = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("_all"))
    both = F.explode(F.array(F.struct("lang", F.lit(False).alias("_all")), whole)).alias("o")
    bins = (
        values.select(F.floor(F.col(column) * BINS).alias("bin"), both)
        .select("bin", "o.*").groupBy("lang", "_all", "bin").count()
    )
    ranked = bins.withColumns({"below": F.sum("count").over(up), "n": F.sum("count").over(every)})
    edge = (F.col("bin") + 1) / BINS
    return ranked.groupBy("lang", "_all").agg(*[
        F.min(F.when(F.col("below") >= F.col("n") * share, edge)).alias(name) for name, share in shares.items()
    ])


def judged(scores: DataFrame) -> DataFrame:
    """`scores` with `perplexity`, `limit` and `kept`.

    Perplexities of short texts scatter, so each is pulled towards the median of
    its language as if it had PRIOR_SIGNS more signs of that.
    """
    scores = scores.withColumn("bits", F.when(F.col("signs") > 0, -F.col("logp") / F.col("signs")))
    trusted = scores.filter("trusted AND signs > 0")
    middle = _quantile(trusted, "bits", {"median": 0.5})

    def join(rows: DataFrame, limits: DataFrame) -> DataFrame:
        own = limits.filter("NOT _all").drop("_all").withColumnRenamed("lang", "_l")
        return rows.join(own, F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l")

    middles = stored(middle, "lm-medians")
    overall = middles.filter("_all").first()
    every = F.lit(overall["median"] if overall else None).cast("double")
    known = join(scores, middles).withColumn("median", F.coalesce("median", every))
    known = known.withColumn("pulled", F.when(
        F.col("signs") > 0, (-F.col("logp") + PRIOR_SIGNS * F.col("median")) / (F.col("signs") + PRIOR_SIGNS)
    ))
    limits = stored(_quantile(known.filter("trusted AND signs > 0"), "pulled", {"high": QUANTILE}), "lm-limits")
    of_all = limits.filter("_all").first()
    every = None if of_all is None else of_all["high"]
    return join(known, limits).withColumns({
        "perplexity": F.exp("pulled"), "limit": F.exp(F.coalesce("high", F.lit(every).cast("double"))),
    }).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(True))).select(
        "key", "digest", "lang", "trusted", "signs", "perplexity", "limit", "kept"
    )


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """key, digest (of the text), lang, trusted, signs, perplexity, limit and kept of every row of `docs`.

    Trusted are the documents that `labels` (doc_id, quality, toxic) has as of
    quality 1 and not as toxic. A text that is null, empty or blank has no
    perplexity and is kept; a null language is a language; one without trusted
    text takes the limit of all; without any trusted text all are kept. Repeated
    rows are rows of their own and train as often; an empty table gives an empty
    result; further columns are not read.
    """
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    good = stored(good.select(F.col("doc_id").cast("long").alias("_good")).distinct(), "trusted-ids")
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
    )
    few = good.count() <= BROADCAST_KEYS
    rows = rows.join(F.broadcast(good) if few else good, F.col("key") == F.col("_good"), "left")
    rows = rows.withColumn("trusted", F.col("_good").isNotNull()).drop("_good")
    blocks = in_blocks(rows)
    # One row for each n-gram of a block. A frequent n-gram has a row for every block, which a skewed join splits.
    asked = stored(block_grams(blocks), "lm-requests")
    counts = stored(asked.groupBy("hi", "lo").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "lm-counts")
    table = probabilities(counts, ("0", "1"))
    discard(counts)
    known = asked.select("block", "hi", "lo").join(table, ["hi", "lo"]).select("block", "hi", "lo", "logp0", "logp1")
    scores = stored(scored_blocks(blocks, known), "lm-scores")
    finished(blocks)
    discard(asked, table)
    return judged(scores)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `docs` but for those that are rejected.

    A row is known by its key, null or not, and its text: of rows that share a key
    only those with a rejected text go, and rejected rows without a key go as well.
    Rows that repeat are judged alike; an empty table gives an empty result.
    """
    rejected = classify(docs, labels, key, text, lang).filter("NOT kept").select("key", "digest").distinct()
    return without_rows(docs, stored(rejected, "rejected"), key, text)
