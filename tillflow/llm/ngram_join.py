"""Jaccard join of word shingles: a size-aware heavy-light join.

Two documents link when 100 * |A and B| >= 80 * |A or B| of their shingle sets.
Equal sets are one set first, so that copies cost nothing further.

Small sets list their subsets: sets of sizes a <= b need an overlap of
`need(a, b)`, so two of them link exactly if they share a subset of that size.
Large sets go through inverted lists. A set is entered under the first elements
of a global order, as many as it takes for linked sets to share one; the order
puts frequent shingles last, so that lists stay short. Candidates of a list are
checked by their exact overlap: first neighbours in a random order, one for all
lists, so that copies meet the same few others everywhere, and the first of each list; then more
neighbours in another order for sets that still lie in different components; then every other pair
that can link. Where a component already holds two sets, their pair is not looked at again.
Each set has a sketch of parities, from which a join tells most pairs that cannot link.
Sets and shingles are told apart by 64 bits of hashes. The boundary between small and large is the size at
which the estimated work is least.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import LOWER, UPPER, arrow_map, discard, record_batch, stored, text_digest, without_rows
from tillflow.llm.components import components

WORDS = 5
# Largest set that may count as small, and work of a list entry against that of a subset.
SMALL_AT_MOST, ENTRY_COST = 24, 6
# Shingles in at least so many sets may be frequent; the most frequent ones are sent to the tasks.
FREQUENT, FREQUENT_AT_MOST = 32, 1 << 16
# Elements of a shard, and bits of a shingle that order and lists go by.
SHARD_SIZE, KEY_BITS = 1 << 22, 40
# Keys that are broadcast to fetch documents, at most; more are shuffled.
BROADCAST_KEYS = 1_000_000
# Entries of a list that are ordered in one piece; sizes in a band differ by a factor of BAND at most.
LIST_PIECE, BAND = 100_000, 1.04
# Neighbours that a set meets in the second order.
WIDTH = 16
# Bits of a sketch, and the size of sets up to which sketches alone decide what is compared exactly.
SKETCH_BITS, SKETCHED = 512, 512

_lower = bytes.maketrans(UPPER.encode(), LOWER.encode())
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def need(a: int, b: int) -> int:
    """The smallest overlap with which sets of these sizes link."""
    return -(-4 * (a + b) // 9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text; its whole sequence if it has fewer words."""
    digest = xxhash.xxh3_64_intdigest
    found = (text or "").encode().translate(_lower).split()
    hashes = np.array([digest(w) for w in found], np.uint64)
    span = min(words, len(hashes))
    if not span:
        return hashes
    total = np.full(len(hashes) - span + 1, span, np.uint64)
    for i in range(span):
        total = total * _FACTOR + hashes[i : len(hashes) - span + 1 + i]
    return np.unique(_mixed(total))


def fingerprint(shingle_set: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - (1 << 63)


def sketch(shingle_set: np.ndarray) -> list[int]:
    """For each cell of hashes whether an odd number of shingles falls into it, as longs.

    Shared shingles cancel out in the XOR of two sketches, so its set bits are at most the shingles that only one set has.
    """
    cells_of = (shingle_set & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells_of, minlength=SKETCH_BITS) & 1).astype(bool)).view(np.int64).tolist()


def sketches_allow(s: str = "sketch", t: str = "other_sketch") -> Column:
    """Whether sets of sizes n and m and these sketches can link: of n + m shingles a ninth at most are not shared."""
    differ = [F.bit_count(F.get(s, F.lit(i)).bitwiseXOR(F.get(t, F.lit(i)))) for i in range(SKETCH_BITS // 64)]
    return F.col("n") + F.col("m") >= 9 * reduce(Column.__add__, differ)


def _sets(batch, column: int):
    """Each distinct set of a batch: (fingerprint, set)."""
    seen = set()
    for text in batch.column(column).to_pylist():
        found = shingles(text)
        if len(found):
            mark = fingerprint(found)
            if mark not in seen:
                seen.add(mark)
                yield mark, found


def set_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, mark and sketch (of the set), digest (of the text) and, for a set that may be small, its shingles."""

    def work(batch):
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        return record_batch([
            ("key", pa.int64(), batch.column(0)), ("n", pa.int64(), [len(s) for s in sets]),
            ("mark", pa.int64(), [fingerprint(s) if len(s) else None for s in sets]), ("digest", pa.binary(), batch.column(2)),
            ("small", pa.list_(pa.int64()), [s.view(np.int64).tolist() if 0 < len(s) <= SMALL_AT_MOST else None for s in sets]),
            ("sketch", pa.list_(pa.int64()), [sketch(s) if len(s) else None for s in sets]),
        ])

    rows = docs.select(F.col(key).cast("long"), F.col(text), text_digest(text).alias("digest"))
    return arrow_map(rows, work, "key long, n long, mark long, digest binary, small array<long>, sketch array<long>")


# --- the boundary ------------------------------------------------------------


def partners(n: int, most: int) -> list[tuple[int, int]]:
    """Size pairs (a, b) of small sets in which a set of size n takes part."""
    return [(a, b) for a in range(1, n + 1) for b in range(n, most + 1) if n in (a, b) and 100 * a >= 80 * b]


def entries_of(n: int) -> int:
    return n - ceil(80 * n / 100) + 1


def boundary(counts: dict[int, int]) -> int:
    """The largest small size with the least work; `counts` sets by size up to SMALL_AT_MOST."""

    def work(most: int) -> int:
        subsets = sum(c * sum(comb(n, need(a, b)) for a, b in partners(n, most)) for n, c in counts.items() if n <= most)
        lists = sum(c * entries_of(n) * ENTRY_COST for n, c in counts.items() if 100 * n > 80 * most)
        return subsets + lists

    return min(range(SMALL_AT_MOST + 1), key=lambda most: (work(most), most))


# --- small sets ---------------------------------------------------------------


def small_links(sets: DataFrame, most: int) -> DataFrame:
    """Links (a, b) between marks that connect all small sets that link."""

    def work(batch):
        out = []
        for mark, small in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            elements = _mixed(np.array(small, np.int64).view(np.uint64) + np.uint64(1)).tolist()
            whole = sum(elements)
            for a, b in partners(len(elements), most):
                left_out = len(elements) - need(a, b)
                for gone in combinations(elements, left_out):
                    key = xxhash.xxh3_64_intdigest(((whole - sum(gone)) % (1 << 64)).to_bytes(8, "little") + bytes([a, b]))
                    out.append((key - (1 << 63), mark, len(elements) == a))
        keys, marks, lower = zip(*out) if out else ((), (), ())
        return record_batch([("k", pa.int64(), keys), ("mark", pa.int64(), marks), ("lower", pa.bool_(), lower)])

    small = sets.filter(F.col("n") <= most).select("mark", "small")
    entries = stored(arrow_map(small, work, "k long, mark long, lower boolean"), "subsets")
    # A set of the smaller size links with all others under its key, so one such set ties them together.
    ties = entries.groupBy("k").agg(F.min(F.when(F.col("lower"), F.col("mark"))).alias("a"), F.count("*").alias("c"))
    return entries.join(ties.filter("a IS NOT NULL AND c > 1"), "k").select("a", F.col("mark").alias("b")).filter("a <> b").distinct()


# --- large sets ---------------------------------------------------------------


def _bits(elements: int) -> int:
    return max(8, ceil(np.log2(max(elements, 1) / SHARD_SIZE)) if elements > SHARD_SIZE else 0)


def _cut(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of sorted keys."""
    shard = (keys >> np.uint64(KEY_BITS - bits)).astype(np.int64)
    begin = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1]) if len(shard) else np.zeros(0, np.int64)
    return [(int(shard[i]), int(i), int(j)) for i, j in zip(begin, [*begin[1:], len(shard)])]


def frequent_shingles(docs: DataFrame, text: str, elements: int) -> np.ndarray:
    """Keys of the most frequent shingles, rarest first; counts are exact and go over all texts.

    A task counts its own shingles first and sends them by shard, as plain numbers.
    """
    bits = _bits(elements)
    low = np.uint64((1 << (KEY_BITS - bits)) - 1)

    def work(batch):
        sets = [s for _, s in _sets(batch, 0)]
        keys = np.sort(np.concatenate(sets) >> np.uint64(64 - KEY_BITS)) if sets else np.zeros(0, np.uint64)
        first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        at = np.nonzero(first)[0]
        times = np.diff([*at, len(keys)])
        keys, rows = keys[at], []
        for shard, i, j in _cut(keys, bits):
            rest, t = (keys[i:j] & low).astype(np.uint32), times[i:j]
            rows.append((shard, rest[t == 1].tobytes(), rest[t > 1].tobytes(), t[t > 1].astype(np.uint32).tobytes()))
        shards, once, more, counts = zip(*rows) if rows else ((), (), (), ())
        return record_batch([
            ("shard", pa.int64(), shards), ("once", pa.binary(), once), ("more", pa.binary(), more), ("times", pa.binary(), counts),
        ])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        once, more, times = (np.frombuffer(b"".join(frame[c]), np.uint32) for c in ("once", "more", "times"))
        keys = np.concatenate([once, more])
        order = np.argsort(keys, kind="stable")
        keys, weight = keys[order], np.concatenate([np.ones(len(once), np.int64), times.astype(np.int64)])[order]
        at = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
        sums = np.add.reduceat(weight, at) if len(at) else weight
        many = sums >= FREQUENT
        high = np.int64(int(frame["shard"].iloc[0]) << (KEY_BITS - bits))
        return pd.DataFrame({"k": keys[at][many].astype(np.int64) | high, "df": sums[many]})

    sent = arrow_map(docs.select(F.col(text)), work, "shard long, once binary, more binary, times binary")
    top = (
        sent.groupBy("shard").applyInPandas(count, "k long, df long")
        .orderBy(F.desc("df"), "k").limit(FREQUENT_AT_MOST).collect()
    )
    return np.array([row["k"] for row in reversed(top)], np.uint64)


def inverted_lists(docs: DataFrame, text: str, elements: int, frequent: np.ndarray, most: int) -> DataFrame:
    """k, mark, n, room: the lists in which at least two sets meet.

    `room` counts a set's elements from this one on, in the global order. Two sets
    have no element in common before their first shared list, so there their
    overlap is at most the smaller room.
    """
    bits = _bits(elements // 5)
    low = np.uint64((1 << (KEY_BITS - bits)) - 1)
    place = np.argsort(frequent)
    known = frequent[place]

    def first(found: np.ndarray) -> np.ndarray:
        """The keys that a set is entered under."""
        keys = found >> np.uint64(64 - KEY_BITS)
        if len(known):
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            often = known[at] == keys
            keys = np.concatenate([keys[~often], keys[often][np.argsort(place[at[often]], kind="stable")]])
        return keys[: entries_of(len(keys))]

    def work(batch):
        sets = [(m, len(s), first(s)) for m, s in _sets(batch, 0) if 100 * len(s) > 80 * most]
        keys = np.concatenate([k for _, _, k in sets]) if sets else np.zeros(0, np.uint64)
        lengths = [len(k) for _, _, k in sets]
        marks = np.repeat(np.array([m for m, _, _ in sets], np.int64), lengths)
        sizes = np.repeat(np.array([n for _, n, _ in sets], np.uint32), lengths)
        places = np.concatenate([np.arange(n, dtype=np.uint32) for n in lengths]) if lengths else sizes
        order = np.argsort(keys, kind="stable")
        keys, marks, sizes, places = keys[order], marks[order], sizes[order], places[order]
        rows = [
            (s, (keys[i:j] & low).astype(np.uint32).tobytes(), *(c[i:j].tobytes() for c in (marks, sizes, places)))
            for s, i, j in _cut(keys, bits)
        ]
        columns = zip(*rows) if rows else ((),) * 5
        names = ("shard", "k", "marks", "sizes", "places")
        return record_batch([(n, pa.binary() if n != "shard" else pa.int64(), c) for n, c in zip(names, columns)])

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        kinds = {"k": np.uint32, "marks": np.int64, "sizes": np.uint32, "places": np.uint32}
        keys, marks, sizes, places = (np.frombuffer(b"".join(frame[c]), kind) for c, kind in kinds.items())
        order = np.lexsort((places, marks, keys))
        keys, marks, sizes, places = keys[order], marks[order], sizes[order].astype(np.int64), places[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])])
        keys, marks, sizes, room = keys[new], marks[new], sizes[new], (sizes - places)[new]
        same = keys[1:] == keys[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        high = np.int64(int(frame["shard"].iloc[0]) << (KEY_BITS - bits))
        return pd.DataFrame({
            "k": keys[shared].astype(np.int64) | high, "mark": marks[shared], "n": sizes[shared], "room": room[shared],
        })

    sent = arrow_map(docs.select(F.col(text)), work, "shard long, k binary, marks binary, sizes binary, places binary")
    return sent.groupBy("shard").applyInPandas(gather, "k long, mark long, n long, room long")


def _fit(most: int) -> str:
    """Whether sets of sizes n and m can link if this is their first list: the needed overlap fits into both rooms."""
    return f"{_fit_rooms()} AND greatest(n, m) > {most}"


def _fit_rooms() -> str:
    return "9 * least(room, other_room) >= 4 * (n + m)"


def neighbours(entries: DataFrame, salt: int, most: int, width: int = 1, apart: Column | None = None) -> DataFrame:
    """Pairs (a, b) of sets that may link: each set with the `width` ones before it in a list, and with the first of the list.

    Sets have one random order in all lists. The first of a list ties copies together in
    few steps, those before help where they do not all link with the first.
    `entries` are k, mark, n, room and what `apart` asks of them; it is a further condition, which
    finds the other's c and sketch as d and other_sketch. Long lists are cut into pieces of the order.
    """
    place = F.xxhash64("mark", F.lit(salt))
    long_lists = entries.groupBy("k").agg(F.ceil(F.count("*") / LIST_PIECE).alias("pieces")).filter("pieces > 1")
    cut = entries.join(long_lists, "k", "left").withColumns({
        "place": place, "piece": F.pmod(F.shiftright(place, 20), F.coalesce("pieces", F.lit(1))),
    })
    line = Window.partitionBy("k", "piece").orderBy("place", "mark")
    names = {"mark": "b", "n": "m", "room": "other_room", "c": "d", "sketch": "other_sketch"}
    own = [c for c in names if c in entries.columns]
    other = F.struct(*[F.col(c).alias(names[c]) for c in own])
    met = [F.lag(other, i).over(line) for i in range(1, width + 1)] + [F.first(other).over(line)]
    near = cut.withColumns({f"_{i}": o for i, o in enumerate(met)})
    near = near.select(*own, F.explode(F.array(*[f"_{i}" for i in range(len(met))])).alias("o")).select(*own, "o.*")
    near = near.filter(f"b IS NOT NULL AND mark <> b AND {_fit(most)}")
    near = near if apart is None else near.filter(apart)
    return near.select(F.least("mark", "b").alias("a"), F.greatest("mark", "b").alias("b")).distinct()


def all_pairs(entries: DataFrame, sketches: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of sets of a list in different components that may link; `entries` are k, mark, n, room and c, `sketches` mark and sketch.

    A set with so much room can have partners of up to 9 / 4 room - n shingles. The
    smaller one of a pair is filed under the band of its size, if it can have a partner
    as large as itself; the larger one asks the bands it may link with. What sketches
    rule out is no row of the join. Sets that only share a list do not meet, and sketches
    travel only to bands of which another component may ask for something.
    """
    reach = (9 * F.col("room") / 4 - F.col("n")).alias("reach")
    band = lambda size: F.floor(F.log(size.cast("double")) / F.log(F.lit(BAND)))
    rows = entries.select("k", "mark", "n", "room", "c", reach)
    filed = rows.filter("reach >= n").select(
        "k", band(F.col("n")).alias("band"), F.col("mark").alias("b"), F.col("n").alias("m"), F.col("room").alias("other_room"),
        F.col("c").alias("d"),
    )
    lowest, highest = band(F.greatest(0.79 * F.col("n"), F.lit(1.0))), band(F.least(F.col("n"), F.col("reach")))
    asking = rows.filter("reach >= 0.79 * n AND reach >= 1").select(
        "k", F.col("mark").alias("a"), "n", "room", "c", F.explode(F.sequence(F.least(lowest, highest), highest)).alias("band")
    )
    bands = filed.groupBy("k", "band").agg(
        F.min("m").alias("m"), F.max("other_room").alias("other_room"), F.min("d").alias("low"), F.max("d").alias("high")
    )
    asking = asking.join(bands, ["k", "band"]).filter(f"m <= n AND (low <> c OR high <> c) AND {_fit_rooms()}")
    asking = stored(asking.select("k", "band", "a", "n", "room", "c"), "asking")
    filed = filed.join(asking.select("k", "band").distinct(), ["k", "band"], "left_semi")
    asking = asking.join(sketches.withColumnRenamed("mark", "a"), "a")
    filed = filed.join(sketches.toDF("b", "other_sketch"), "b")
    met = asking.join(filed, ["k", "band"]).filter(f"(m < n OR (m = n AND a < b)) AND c <> d AND {_fit(most)}").filter(sketches_allow())
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cells(shingle_set: np.ndarray) -> bytes:
    """A bitmap of the cells that the shingles' leading bits fall into; two to four cells for each shingle."""
    width = max(3, int(2 * len(shingle_set) - 1).bit_length())
    taken = np.zeros(1 << width, bool)
    taken[shingle_set >> np.uint64(64 - width)] = True
    return np.packbits(taken).tobytes()


def may_link(a: bytes, b: bytes, n: int, m: int) -> bool:
    """Whether sets of these cells and sizes can link: what lies in a cell that the other has not is not shared."""
    x, y = (np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool) for bits in (a, b))
    size = min(len(x), len(y))
    x, y = (bits.reshape(size, -1).any(1) for bits in (x, y))
    return min(n - int((x & ~y).sum()), m - int((y & ~x).sum())) >= need(n, m)


def _fetched(docs: DataFrame, sets: DataFrame, pairs: DataFrame, key: str, text: str, of_set) -> DataFrame:
    """mark, n and `of_set(shingles)` of every set that occurs in `pairs`, worked out again from one of its documents."""
    wanted = stored(pairs.select(F.col("a").alias("mark")).union(pairs.select(F.col("b").alias("mark"))).distinct(), "wanted")
    keys = stored(sets.join(wanted, "mark").select("key").distinct(), "wanted-keys")
    few = keys.count() <= BROADCAST_KEYS
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(keys) if few else keys, F.col("doc").eqNullSafe(F.col("key")), "left_semi")

    def work(batch):
        found = list(_sets(batch, 0))
        return record_batch([
            ("mark", pa.int64(), [m for m, _ in found]), ("n", pa.int64(), [len(s) for _, s in found]),
            ("value", pa.binary(), [of_set(s) for _, s in found]),
        ])

    found = arrow_map(rows.select("text"), work, "mark long, n long, value binary").join(wanted, "mark", "left_semi")
    return stored(found.dropDuplicates(["mark"]), "wanted-sets")


def _tested(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """The pairs (a, b) whose values pass `test(value, value, size, size)`."""
    both = pairs.join(values.toDF("a", "n", "s"), "a").join(values.toDF("b", "m", "t"), "b")

    def work(batch):
        columns = [batch.column(i).to_pylist() for i in range(2, 6)]
        at = pa.array(np.nonzero([test(*row) for row in zip(*columns)])[0])
        return record_batch([("a", pa.int64(), batch.column(0).take(at)), ("b", pa.int64(), batch.column(1).take(at))])

    return arrow_map(both.select("a", "b", "s", "t", "n", "m"), work, "a long, b long")


def overlaps(s: bytes, t: bytes, n: int, m: int) -> bool:
    joint = np.sort(np.concatenate([np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)]))
    return int((joint[1:] == joint[:-1]).sum()) >= need(n, m)


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of marks whose sets link, by their exact overlap.

    Sketches rule out most others. They say little of large sets, whose cells are compared
    before the sets themselves are sent.
    """
    known = sets.select("mark", "n", "sketch")
    both = pairs.join(known.toDF("a", "n", "sketch"), "a").join(known.toDF("b", "m", "other_sketch"), "b")
    near = stored(both.filter(sketches_allow()).select("a", "b", (F.greatest("n", "m") > SKETCHED).alias("large")), "pairs-near")
    large = near.filter("large").select("a", "b")
    kept = _tested(large, _fetched(docs, sets, large, key, text, cells), may_link)
    left = stored(near.filter("NOT large").select("a", "b").union(kept), "pairs-left")
    return _tested(left, _fetched(docs, sets, left, key, text, lambda s: s.tobytes()), overlaps)


def set_links(docs: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """Links (a, b) between marks whose components are those of all links."""
    counts = {r["n"]: r["c"] for r in sets.filter(F.col("n") <= SMALL_AT_MOST).groupBy("n").agg(F.count("*").alias("c")).collect()}
    most = boundary(counts)
    links = small_links(sets, most)
    elements = sets.agg(F.sum("n")).first()[0] or 0
    frequent = frequent_shingles(docs, text, elements)
    lists = stored(inverted_lists(docs, text, elements, frequent, most), "lists")
    tried = stored(neighbours(lists, 1, most), "pairs")
    links = stored(links.union(verified(docs, sets, tried, key, text)), "links-found")
    sketches = sets.select("mark", "sketch")
    for last in (False, True):
        known = components(links)
        at = lists.join(known, F.col("mark") == F.col("node"), "left").select(
            "k", "mark", "n", "room", F.coalesce("component", "mark").alias("c")
        )
        open_lists = at.groupBy("k").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("k")
        at = stored(at.join(open_lists, "k"), "open-lists")
        apart = (F.col("c") != F.col("d")) & sketches_allow()
        new = all_pairs(at, sketches, most) if last else neighbours(at.join(sketches, "mark"), 2, most, WIDTH, apart)
        new = stored(new.join(tried, ["a", "b"], "left_anti"), "pairs")
        links = stored(links.union(verified(docs, sets, new, key, text)), "links-found")
        tried = tried.union(new)
        discard(at)
    return links


def with_components(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, digest, n, mark, component (a mark, null without shingles) and root (its smallest key) of every row."""
    rows = stored(set_rows(docs, key, text), "shingle-sets")
    sets = stored(
        rows.filter("n > 0").groupBy("mark")
        .agg(F.min("key").alias("key"), *[F.any_value(c).alias(c) for c in ("n", "small", "sketch")]),
        "distinct-sets",
    )
    found = components(set_links(docs, sets, key, text))
    named = stored(
        sets.join(found, F.col("mark") == F.col("node"), "left")
        .select("mark", F.col("key").alias("smallest"), F.coalesce("component", "mark").alias("component")),
        "set-components",
    )
    roots = named.groupBy("component").agg(F.min("smallest").alias("root"))
    named = named.join(roots, "component").select("mark", "component", "root")
    return rows.select("key", "digest", "n", "mark").join(named, "mark", "left")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id (smallest key reachable by links) of every row of `docs`.

    A null or blank text has no shingles and links with nothing: it is its own
    component, and so is every other such row. Rows with equal sets link. A null
    key names no component unless its row is alone. Repeated rows are rows of their
    own; an empty table gives an empty result; further columns are not read.
    """
    return with_components(docs, key, text).select(
        "key", F.col("n").alias("n_shingles"), F.coalesce("root", "key").alias("component_id")
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of rows that link, directly or not, and all that link with none.

    The row of the smallest key stays (rows without a key come last), of equal keys the one
    whose text has the smallest digest. Rows that repeat in key and text stay or go
    together; a key that two texts share loses only the one that links with another row.
    Texts without shingles stay. An empty table gives an empty result.
    """
    rows = stored(with_components(docs, key, text).filter("component IS NOT NULL").select("key", "digest", "component"), "linked-rows")
    rank = F.struct(F.col("key").isNull(), "key", "digest")
    best = rows.groupBy("component").agg(F.min(rank).alias("best"))
    gone = rows.withColumn("rank", rank).join(best, "component").filter(~F.col("rank").eqNullSafe(F.col("best")))
    return without_rows(docs, stored(gone.select("key", "digest").distinct(), "near-copies"), key, text)
