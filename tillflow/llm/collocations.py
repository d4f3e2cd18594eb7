"""Phrase collocations from suffix subtrees that are built apart, group by group.

Every word of a text begins a suffix, cut to the longest phrase of interest. A tree
of all suffixes holds the count of each phrase at the node it leads to: the leaves
below. The tree is never built in one piece. Suffixes are parted by the words
that they begin with, their prefix: a prefix with more suffixes than a group may
hold is extended by a word, again and again; the others are packed into groups up
to that budget. Each group's subtree is then built by itself: its suffixes are
sorted, equal ones stand together, and a node's count is the total of its leaves.

A phrase that occurs often enough has only words and word pairs that do, so
suffixes end before a pair that is too rare: nothing that is asked for gets lost.

Words are known by a 64-bit hash that holds the group (a language) too. The hashes
are proved: a second hash of every occurrence must agree wherever the first does,
or all is done again under another seed.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import key_filter, words
from tillflow.llm.common import record_batch, shipped, stored

# What ends a word, what no phrase crosses, the longest phrase, and the parts of a score.
BLANKS, BORDERS = b" \t", b".,;:!?\n\x0b\x0c\r"
LONGEST, SCALE = 5, 1000
# Least count of a phrase, percentage of its count at which a longer one absorbs it, phrases reported for each group.
LEAST, SHARE, TOP = 100, 100, 2000
# Suffixes that one group holds at most; cells of prefixes that groups are packed from; words that a task takes at a time.
BUDGET, CELL_BITS, SLICE_WORDS = 500_000, 20, 2_000_000

# Seeds of second hashes lie so far from those of the first.
CHECK_SEED = 1 << 20

KINDS = words.kinds(words.IN_WORD, blank=BLANKS, border=BORDERS)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _group_number(name: str, seed: int) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), "little"))


def _keys(found: words.Words, groups: list[str], seed: int) -> np.ndarray:
    """The hash of every word and its group; never zero, which stands for no word."""
    known = {name: _group_number(name, seed) for name in set(groups)}
    of_text = np.array([known[name] for name in groups], dtype=np.uint64)
    return np.maximum(words.mixed(words.hashes(found, seed) + of_text[found.text]), np.uint64(1))


def _extended(prefix: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The hash of a prefix with one word more."""
    return words.mixed(prefix * MULTIPLIER + key)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where, in sorted rows, another row begins."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _slices(batches: Iterator[pa.RecordBatch], read: Callable, make: Callable) -> Iterator[pa.RecordBatch]:
    """`make` over the columns that `read` gets from batches, several batches at a time."""
    held, size = [], 0
    for batch in batches:
        columns = read(batch)
        held.append(columns)
        size += len(columns[0])
        if size >= SLICE_WORDS:
            yield from make(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield from make(*map(np.concatenate, zip(*held)))


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


class Pairs:
    """The words of a batch, and which of them begin a pair of frequent words or a frequent pair."""

    def __init__(self, batch: pa.RecordBatch, seed: int, frequent: np.ndarray, pairs: np.ndarray | None = None):
        self.found = words.find(batch["text"], KINDS)
        self.groups = batch["name"].to_pylist()
        self.keys = _keys(self.found, self.groups, seed)
        self.known = key_filter.maybe_in(frequent, self.keys)
        self.next = np.append(self.keys[1:], np.uint64(0))[: len(self.keys)]
        self.pair = _extended(self.keys, self.next)
        self.linked = self.found.follows & self.known
        self.linked[:-1] &= self.known[1:]
        if pairs is not None:
            self.linked &= key_filter.maybe_in(pairs, self.pair)

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a frequent pair begins, and the suffixes there: word keys, zero after the end."""
        at = np.flatnonzero(self.linked)
        rows = np.zeros((len(at), LONGEST), dtype=np.uint64)
        rows[:, 0] = self.keys[at]
        alive, linked = np.ones(len(at), dtype=bool), np.concatenate([self.linked, np.zeros(LONGEST, bool)])
        keys = np.concatenate([self.keys, np.zeros(LONGEST, np.uint64)])
        for d in range(1, LONGEST):
            alive = alive & linked[at + d - 1]
            rows[:, d] = np.where(alive, keys[at + d], np.uint64(0))
        return at, rows


def _named(docs: DataFrame, text: str, group: str) -> DataFrame:
    return shipped(docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("name"), F.col(text).alias("text")))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """For every word key its count `n` and its least and largest second hash; beside them, under a null key, each group's words."""

    def make(keys, checks):
        order = np.argsort(keys)
        keys, checks = keys[order], checks[order]
        heads = _runs(keys)
        low, high = (f.reduceat(checks, heads) if len(heads) else checks for f in (np.minimum, np.maximum))
        yield record_batch([
            ("key", pa.int64(), _signed(keys[heads])), ("name", pa.string(), pa.nulls(len(heads), pa.string())),
            ("n", pa.int64(), np.diff(np.append(heads, len(keys)))),
            ("low", pa.int64(), _signed(low)), ("high", pa.int64(), _signed(high)),
        ])

    def run(batches):
        totals = Counter()

        def read(batch):
            found = words.find(batch["text"], KINDS)
            groups = batch["name"].to_pylist()
            for name, count in zip(groups, found.counts().tolist()):
                totals[name] += count
            return _keys(found, groups, seed), _keys(found, groups, seed + CHECK_SEED)

        yield from _slices(batches, read, make)
        empty = pa.nulls(len(totals), pa.int64())
        yield record_batch([
            ("key", pa.int64(), empty), ("name", pa.string(), list(totals)), ("n", pa.int64(), list(totals.values())),
            ("low", pa.int64(), empty), ("high", pa.int64(), empty),
        ])

    counted = docs.mapInArrow(run, "key long, name string, n long, low long, high long")
    return counted.groupBy("key", "name").agg(
        F.sum("n").alias("n"), (F.min("low") != F.max("high")).alias("mixed"), F.max(F.col("low") != F.col("high")).alias("torn")
    ).withColumn("mixed", F.coalesce(F.col("mixed"), F.lit(False)) | F.coalesce(F.col("torn"), F.lit(False))).drop("torn")


def pair_counts(docs: DataFrame, seed: int, frequent: Broadcast) -> DataFrame:
    """The count of every pair of frequent words (first, pair, n); beside them, under a null pair, every frequent word's text."""

    def run(batches):
        held: list[tuple] = []
        size, told = 0, set()

        def flush():
            first, pair = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            order = np.argsort(pair)
            first, pair = first[order], pair[order]
            heads = _runs(pair)
            none = pa.nulls(len(heads), pa.string())
            return record_batch([
                ("first", pa.int64(), _signed(first[heads])), ("pair", pa.int64(), _signed(pair[heads])),
                ("n", pa.int64(), np.diff(np.append(heads, len(pair)))), ("word", pa.string(), none), ("name", pa.string(), none),
            ])

        for batch in batches:
            text = Pairs(batch, seed, frequent.value)
            held.append((text.keys[text.linked], text.pair[text.linked]))
            size += len(held[-1][0])
            known = np.flatnonzero(text.known)
            keys, places = np.unique(text.keys[known], return_index=True)
            new = [(int(k), int(known[j])) for k, j in zip(keys, places) if int(k) not in told]
            if len(told) > SLICE_WORDS:
                told.clear()  # words may be told again
            told.update(k for k, _ in new)
            empty = pa.nulls(len(new), pa.int64())
            yield record_batch([
                ("first", pa.int64(), _signed(np.array([k for k, _ in new], dtype=np.uint64))), ("pair", pa.int64(), empty),
                ("n", pa.int64(), empty), ("word", pa.string(), [text.found.word(j).decode() for _, j in new]),
                ("name", pa.string(), [text.groups[text.found.text[j]] for _, j in new]),
            ])
            if size >= SLICE_WORDS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    found = docs.mapInArrow(run, "first long, pair long, n long, word string, name string")
    return found.groupBy("first", "pair").agg(F.sum("n").alias("n"), F.min("word").alias("word"), F.min("name").alias("name"))


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    prefixes = np.empty_like(rows)
    prefixes[:, 0] = rows[:, 0]
    for d in range(1, LONGEST):
        prefixes[:, d] = _extended(prefixes[:, d - 1], rows[:, d])
    return prefixes


def _split_depths(rows: np.ndarray, prefixes: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """How many words of each suffix its prefix takes: one more while the prefix is heavy and the suffix goes on."""
    depth = np.ones(len(rows), dtype=np.int64)
    for d, bitmap in enumerate(heavy, 1):
        more = (depth == d) & (rows[:, d] != 0) & key_filter.maybe_in(bitmap, prefixes[:, d - 1])
        depth[more] += 1
    return depth


def prefix_counts(docs: DataFrame, seed: int, frequent: Broadcast, pairs: Broadcast, heavy: list[Broadcast]) -> DataFrame:
    """Counts of the prefixes of one word more than `heavy` has depths, where the shorter prefix is heavy."""
    depth = len(heavy) + 1

    def read(batch):
        _, rows = Pairs(batch, seed, frequent.value, pairs.value).suffixes()
        prefixes = _prefix_hashes(rows)
        reached = _split_depths(rows, prefixes, [h.value for h in heavy]) == depth
        return (prefixes[reached, depth - 1],)

    def make(keys):
        keys = np.sort(keys)
        heads = _runs(keys)
        yield record_batch([("prefix", pa.int64(), _signed(keys[heads])), ("n", pa.int64(), np.diff(np.append(heads, len(keys))))])

    def run(batches):
        return _slices(batches, read, make)

    return docs.mapInArrow(run, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))


def packed(cells: np.ndarray, sizes: np.ndarray, budget: int) -> np.ndarray:
    """The group of each cell: cells in order, a new group whenever the budget would be passed."""
    groups = np.zeros(1 << CELL_BITS, dtype=np.int32)
    order = np.argsort(cells)
    group, filled, last = 0, 0, 0
    for cell, size in zip(cells[order].tolist(), sizes[order].tolist()):
        if filled and filled + size > budget:
            group, filled = group + 1, 0
            groups[last + 1 :] = group
        filled += size
        last = cell
        groups[cell:] = group
    return groups


def group_of_cells(leaf_prefixes: DataFrame, budget: int) -> np.ndarray:
    """Groups of prefixes, packed from the sums of at most 2 ** CELL_BITS cells."""
    cell = F.shiftrightunsigned("prefix", 64 - CELL_BITS)
    table = leaf_prefixes.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).toArrow()
    return packed(table["cell"].to_numpy(), table["n"].to_numpy(), budget)


def grouped_suffixes(
    docs: DataFrame, seed: int, frequent: Broadcast, pairs: Broadcast, heavy: list[Broadcast], groups: Broadcast
) -> DataFrame:
    """All suffixes by the group that their prefix is in: for each task's slice of words and group one row, packed.

    A packed suffix is LONGEST + 2 numbers: its words, its count, the words that its prefix has.
    """

    def read(batch):
        _, rows = Pairs(batch, seed, frequent.value, pairs.value).suffixes()
        return (rows,)

    def make(rows):
        rows = rows[np.lexsort(rows.T[::-1])]
        heads = _runs(*rows.T)
        n = np.diff(np.append(heads, len(rows)))
        rows = rows[heads]
        prefixes = _prefix_hashes(rows)
        depth = _split_depths(rows, prefixes, [h.value for h in heavy])
        group = groups.value[prefixes[np.arange(len(rows)), depth - 1] >> np.uint64(64 - CELL_BITS)]
        packed_rows = np.column_stack([rows.view(np.int64), n, depth])
        order = np.argsort(group, kind="stable")
        packed_rows, group = packed_rows[order], group[order]
        starts = _runs(group)
        ends = np.append(starts[1:], len(group))
        yield record_batch([
            ("g", pa.int32(), group[starts]),
            ("suffixes", pa.binary(), [packed_rows[a:b].tobytes() for a, b in zip(starts, ends)]),
        ])

    def run(batches):
        return _slices(batches, read, make)

    return docs.mapInArrow(run, "g int, suffixes binary")


def subtree_counts(suffixes: DataFrame, least: int) -> DataFrame:
    """words (array of keys) and `n` of the phrases of two words and more, from each group's subtree.

    Nodes no deeper than a group's prefixes can lie in other groups too; their parts are added up.
    """

    def build(group: pa.Table) -> pa.Table:
        found = np.concatenate([np.frombuffer(part.as_py(), dtype=np.int64).reshape(-1, LONGEST + 2) for part in group["suffixes"]])
        rows, leaves, depth = found[:, :LONGEST], found[:, LONGEST], found[:, LONGEST + 1]
        order = np.lexsort(rows.T[::-1])
        rows, leaves, depth = rows[order], leaves[order], depth[order]
        phrases, counts = [], []
        new = np.zeros(len(rows), dtype=bool)
        new[:1] = True
        for d in range(LONGEST):
            new[1:] |= rows[1:, d] != rows[:-1, d]
            if not d:
                continue
            heads = np.flatnonzero(new)
            total = np.add.reduceat(leaves, heads)
            split = np.maximum.reduceat(depth, heads) > d
            node = (rows[heads, d] != 0) & ((total >= least) | split)
            phrases.extend(rows[heads[node], : d + 1].tolist())
            counts.append(total[node])
        return pa.table({
            "words": pa.array(phrases, pa.list_(pa.int64())), "n": pa.array(np.concatenate(counts), pa.int64()),
        })

    nodes = suffixes.groupBy("g").applyInArrow(build, "words array<long>, n long")
    return nodes.groupBy("words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def frequent_phrases(
    docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, budget: int = BUDGET
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of one to LONGEST words with `least` occurrences or more, by word keys (words, n); the words (key, word,
    name, n); and the number of words of each group (name, n)."""
    source = _named(docs, text, group)
    for seed in range(1, 100):
        counts = stored(word_counts(source, seed).filter((F.col("n") >= least) | F.col("key").isNull()), "phrase-words")
        if counts.filter(F.col("key").isNotNull() & F.col("mixed")).isEmpty():
            break
    else:
        raise RuntimeError("word hashes met under every seed")
    totals = counts.filter("key IS NULL").select("name", "n")
    single = counts.filter("key IS NOT NULL").select("key", "n")
    frequent = key_filter.bitmap_of(single, "key")
    pairs_and_words = stored(
        pair_counts(source, seed, frequent).filter((F.col("n") >= least) | F.col("pair").isNull()), "phrase-pairs"
    )
    vocabulary = pairs_and_words.filter("pair IS NULL").select(F.col("first").alias("key"), "word", "name").join(single, "key")
    pairs = pairs_and_words.filter("pair IS NOT NULL").select("first", "pair", "n")
    linked = key_filter.bitmap_of(pairs, "pair")

    # Prefixes: first words, pairs of heavy first words, and so on.
    limit = max(1, budget // 2)
    level = pairs.groupBy(F.col("first").alias("prefix")).agg(F.sum("n").alias("n"))
    leaf_prefixes, heavy = level, []
    while len(heavy) < LONGEST - 1:
        above = level.filter(F.col("n") > limit)
        if above.isEmpty():
            break
        heavy.append(key_filter.bitmap_of(above, "prefix"))
        leaf_prefixes = leaf_prefixes.filter(~(F.col("n") > limit))
        level = stored(prefix_counts(source, seed, frequent, linked, heavy), "phrase-prefixes")
        leaf_prefixes = leaf_prefixes.unionByName(level)
    groups = source.sparkSession.sparkContext.broadcast(group_of_cells(leaf_prefixes, budget))

    suffixes = grouped_suffixes(source, seed, frequent, linked, heavy, groups)
    phrases = stored(
        subtree_counts(suffixes, least).unionByName(single.select(F.array("key").alias("words"), "n")), "phrase-counts"
    )
    return phrases, stored(vocabulary, "phrase-vocabulary"), totals


def scored(phrases: DataFrame, vocabulary: DataFrame, totals: DataFrame, share: int = SHARE) -> DataFrame:
    """The phrases that no longer one absorbs: words, name, a, l, r, n, score by the lowest cut."""
    candidates = phrases.filter(F.size("words") > 1).withColumnRenamed("n", "a")
    # A phrase that absorbs a shorter one by way of several words does so by way of each one between.
    inside = candidates.filter(F.size("words") > 2).select(
        F.explode(F.array(
            F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1)
        )).alias("words"), F.col("a").alias("longer"),
    ).groupBy("words").agg(F.max("longer").alias("longer"))
    left = candidates.join(inside, "words", "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))
    ).drop("longer")
    name_of = vocabulary.select(F.col("key").alias("first"), "name")
    cuts = left.withColumn("first", F.element_at("words", 1)).join(name_of, "first").join(totals, "name").select(
        "words", "name", "a", "n", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    )
    heads = phrases.select(F.col("words").alias("head"), F.col("n").alias("l"))
    tails = phrases.select(F.col("words").alias("tail"), F.col("n").alias("r"))
    parts = (
        cuts.withColumns({
            "head": F.slice("words", F.lit(1), F.col("k")), "tail": F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")),
        }).join(heads, "head").join(tails, "tail")
    )
    # Below 10 ** 18 occurrences of a phrase and 10 ** 15 words, 38 digits hold every product.
    score = F.expr(
        f"(cast({SCALE} as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(15,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    return parts.withColumn("score", score).groupBy("words", "name", "a", "n").agg(lowest.alias("cut")).select(
        "words", "name", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def collocations(
    docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """The `top` phrases of each group by score: name, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z) and cut into pieces at `.,;:!?` and line ends, and
    pieces into words at blanks and tabs. A phrase is two to LONGEST words in a row of
    a piece; `a` counts all its places, overlapping ones too. Cut into two phrases with
    counts l and r, of n words in the group, it scores floor(1000 a n / (l r)); of its
    cuts the lowest counts, the first of equal ones. Phrases with a < `least` are left
    out, and those that lie in a longer phrase of `share` per cent of their count or more.
    Equal scores rank by count, then by phrase.

    A null group is `und`; a null text has no words, like an empty one; rows that
    repeat count each. An empty table gives an empty result; further columns are not
    read, whatever their names. Two words are told apart by 128 bits of hashes.
    """
    phrases, vocabulary, totals = frequent_phrases(docs, text, group, least, budget)
    found = scored(phrases, vocabulary, totals, share)
    by_score = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("a"))
    # All that tie with the last place; their words are looked up, and the order made whole.
    leaders = found.withColumn("place", F.rank().over(by_score)).filter(F.col("place") <= top).drop("place")
    spelled = (
        leaders.select("*", F.posexplode("words").alias("i", "key")).join(vocabulary.select("key", "word"), "key")
        .groupBy("words", "name", "a", "l", "r", "n", "score")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select(
        "name", "rank", "phrase", "a", "l", "r", "n", "score"
    )
