"""A small corpus with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
# Columns that operators use as names of their own.
EXTRA = {name: "clash" for name in ("key", "digest", "row", "kept", "size", "k", "mark", "shard", "copy", "copies", "n", "ids", "block")}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows() -> list[tuple]:
    texts = [
        "Hello brave world, it's a fine day", "Hello brave world, it's a fine day", "hello brave world, it's a fine day",
        None, None, "", "   \t\n ", "x", "X", "é́　日本語 😀 \x00 ▁ <s> <|endoftext|>",
        " ".join(BASE), " ".join(BASE), " ".join([*BASE, "more"]), " ".join(BASE[:-1]), " ".join([*BASE[:8], "other", *BASE[9:]]),
        LONG, LONG + " tail", LONG, "a" * 5000, "word " * 400,
        "der die das und nicht ist ein eine", "the and that with from have this", "le la les des et une dans",
    ]
    found = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", "é", None, "s1", "s1")[i % 6], len(t or "")) for i, t in enumerate(texts)]
    # Rows that repeat, ids that repeat with another text, and rows without an id.
    return [*found, found[0], found[0], (7, "another text of seven", "en", "s2", 21), (None, "no id", "en", "s1", 5), (None, None, None, None, None)]


def frame(spark, data=None, extra: bool = True):
    from pyspark.sql import functions as F

    made = spark.createDataFrame(rows() if data is None else data, COLUMNS).repartition(3)
    return made.withColumns({name: F.lit(value) for name, value in EXTRA.items()}) if extra else made


def empty(spark):
    return frame(spark, []).limit(0)


def words(text) -> list[str]:
    return WORD.findall(text or "")


def shingle_set(text) -> frozenset:
    found = words((text or "").translate(A_TO_Z))
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def classes(count: int, linked) -> list[int]:
    """The smallest member of each item's component, from pairs of numbers."""
    root = list(range(count))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def shingle_links(sets: list[frozenset]):
    holders = defaultdict(list)
    for i, found in enumerate(sets):
        for shingle in found:
            holders[shingle].append(i)
    for i, found in enumerate(sets):
        shared = defaultdict(int)
        for shingle in found:
            for j in holders[shingle]:
                if j < i:
                    shared[j] += 1
        yield from ((i, j) for j, n in shared.items() if 100 * n >= 80 * (len(found) + len(sets[j]) - n))
