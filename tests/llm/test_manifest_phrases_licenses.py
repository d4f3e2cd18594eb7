"""The Merkle manifest, collocations and license scans, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
import pytest

from tillflow.llm import collocations, key_filter, license_scan, merkle_manifest, words


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark)


# --- 11 ----------------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text) -> str:
    values = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_levels(nodes: list) -> list:
    levels = [nodes]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)])
    return levels


def siblings(levels: list, place: int):
    for nodes in levels[:-1]:
        start = place // 8 * 8
        yield nodes[start:place], nodes[place + 1 : start + 8]
        place //= 8


def brute_manifest(rows: list) -> Counter:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    for name in names:
        trees[name].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row, row[1])))
    levels = {name: tree_levels([leaf(row, row[1]) for row in trees[name]]) for name in names}
    crown = tree_levels([levels[name][-1][0] for name in names])
    found = Counter()
    for j, name in enumerate(names):
        for i, row in enumerate(trees[name]):
            path = [*siblings(levels[name], i), *siblings(crown, j)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf(row, row[1].translate(corpus.A_TO_Z) if changed and row[1] is not None else row[1])
            for before, after in path:
                node = sha("".join([*before, node, *after]))
            found[
                row[0], leaf(row, row[1]), levels[name][-1][0], crown[-1][0],
                sha("".join("".join(before + after) for before, after in path)), node, node == crown[-1][0],
            ] += 1
    return found


def many_rows(count: int) -> list[tuple]:
    pick = random.Random(11)
    langs = [None, "", "en", "de", "é", "zz", *[f"l{i}" for i in range(10)]]
    return [
        (None if i % 50 == 0 else i, f"Text {pick.random()}", "en" if i % 3 else pick.choice(langs), pick.choice(["s", None]), i)
        for i in range(count)
    ]


@pytest.mark.parametrize("rows", [corpus.rows(), many_rows(700), [(1, "One Leaf", "en", "s", 8)], [(None, "Same", None, None, None)] * 70])
def test_manifest(spark, rows):
    for levels in (1, 4):
        found = merkle_manifest.tampered(corpus.frame(spark, rows), block_levels=levels).collect()
        assert Counter(tuple(r)[:7] for r in found) == brute_manifest(rows)


def test_versions_share_all_but_the_path(spark):
    rows = many_rows(300)
    proofs = merkle_manifest.tampered(corpus.frame(spark, rows), block_levels=1)
    kept = proofs.collect()
    changed = [r for r in kept if r.copies is not None]
    assert {r.key for r in changed} == {i for i in range(300) if i % 50 and zlib.crc32(str(i).encode()) % 3 == 0}
    # One node for each level from the leaf's parent to the root; the last one is the version's root.
    assert all(r.copies[-1] == r.folded_root and len(r.copies) <= 3 + 2 for r in changed)
    assert merkle_manifest.version_nodes(proofs).count() == sum(len(r.copies) for r in changed)
    tree = merkle_manifest.BlockTree([sha(str(i)) for i in range(20)], 2)
    before = [list(level) for level in tree.runs]
    copies = merkle_manifest.copied(sha("other"), tree.path(19))
    assert tree.runs == before and len(copies) == 2 and copies[-1] != tree.root
    assert merkle_manifest.copied(sha("19"), tree.path(19))[-1] == tree.root


def test_manifest_of_nothing(spark):
    assert merkle_manifest.tampered(corpus.empty(spark)).collect() == []


# --- 12 ----------------------------------------------------------------------


def brute_collocations(rows, least, share=100, top=2000) -> set:
    totals, count = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und" if lang != "" else ""
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(corpus.A_TO_Z)):
            found = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(found)
            for i in range(len(found)):
                for m in range(1, 6):
                    if i + m <= len(found):
                        count[lang, tuple(found[i : i + m])] += 1
    by_lang: dict = {}
    candidates = {k: a for k, a in count.items() if a >= least and len(k[1]) > 1}
    absorbed = set()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * a >= share * count[lang, p[i : i + m]]:
                    absorbed.add((lang, p[i : i + m]))
    for (lang, p), a in candidates.items():
        if (lang, p) not in absorbed:
            score, _, l, r = min(
                (1000 * a * totals[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]])
                for k in range(1, len(p))
            )
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in by_lang.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    }


def phrase_rows() -> list[tuple]:
    pick = random.Random(12)
    signs = ["the", "The", "of", "a", "É", "é", "日本", "x", "kick", "the bucket", "new york city hall", "aa aa aa", ",", ". ", "\n", "\t", "  "]
    made = [(i, " ".join(pick.choices(signs, k=60)), pick.choice(["en", "de", None, ""]), None, 0) for i in range(120)]
    return [*made, *[(i, "in no time at all it ends", "en", None, 0) for i in range(40)], (1, "w" * 9000 + " b", "en", None, 0)]


def test_collocations(spark):
    rows = [*corpus.rows(), *phrase_rows()]
    frame = corpus.frame(spark, rows)
    for least, share, top, budget in ((5, 100, 2000, 500_000), (5, 100, 2000, 7), (3, 60, 12, 300), (2, 100, 3, 1)):
        found = collocations.collocations(frame, least=least, share=share, top=top, budget=budget).collect()
        assert {tuple(r) for r in found} == brute_collocations(rows, least, share, top) and found
    assert collocations.collocations(corpus.empty(spark)).collect() == []


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([([1], 10**14), ([2], 3), ([1, 2], 3)], "words array<long>, n long")
    vocabulary = spark.createDataFrame([(1, "a", "en", 1), (2, "b", "en", 1)], "key long, word string, name string, n long")
    totals = spark.createDataFrame([("en", 10**15 - 1)], "name string, n long")
    row = collocations.scored(phrases, vocabulary, totals).first()
    assert row.score == 1000 * 3 * (10**15 - 1) // (10**14 * 3)


def test_hashes_that_meet_are_noticed(spark, monkeypatch):
    source = collocations._named(corpus.frame(spark, [(1, "a b a", "en", None, 0)]), "text", "lang")
    assert not collocations.word_counts(source, 1).filter("mixed").count()
    torn = spark.createDataFrame([(5, None, 1, 1, 1), (5, None, 1, 2, 2)], "key long, name string, n long, low long, high long")
    merged = torn.groupBy("key").agg({"low": "min", "high": "max"}).first()
    assert merged["min(low)"] != merged["max(high)"]


def test_groups_keep_to_the_budget():
    cells, sizes = np.array([9, 2, 5, 700]), np.array([4, 3, 9, 1])
    groups = collocations.packed(cells, sizes, 8)
    held = Counter()
    for cell, size in zip(cells, sizes):
        held[groups[cell]] += size
    assert sorted(held.values()) == [3, 5, 9] and list(np.diff(groups) >= 0) == [True] * (len(groups) - 1)


# --- 13 ----------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSED = [
    (100, "Under  the MIT-license!! under the mit license"), (101, "cc by nc cc by nc cc BY nc"), (101, "cc by nc"),
    (None, "cc by nc"), (None, "cc by nc"), (102, "This work is licensed under GNU General Public License, version 3"),
    (103, "Licensed under CC BY-SA 4.0"), (104, "released under the gnu license"),
    (105, "é under the mit license " + "x" * 6000 + " y"), (106, ("w " * 50 + "Licensed under the Apache License, Version 2.0. ") * 300),
    (107, "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    (108, "released under " * 50 + "the mit licence"), (109, "permission is hereby granted " * 40),
]


def license_rows() -> list[tuple]:
    return [*corpus.rows(), *[(k, t, "en", "s", len(t)) for k, t in LICENSED]]


def base_places(text) -> tuple:
    found = LICENSE_WORD.findall((text or "").translate(corpus.A_TO_Z))
    places = [
        (i, label) for label, phrase in license_scan.BASE for i in range(len(found)) if found[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(found), len(at), min(at, default=None), max(at, default=None), labels


def test_license_phrases(spark):
    found = license_scan.scan(corpus.frame(spark, license_rows())).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter((r[0], *base_places(r[1])) for r in license_rows())
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in found)
    labels = {r.key: (r.labels, round(r.score, 3)) for r in found}
    assert labels[102] == ("gpl-3", round(11 / 12, 3)) and labels[107] == ("cc-by-nc", 1.0)
    assert labels[103] == labels[104] == labels[108] == labels[109] == labels[7] == ("", 0.0)
    assert license_scan.scan(corpus.empty(spark)).collect() == []


def test_diagonals_lose_no_edited_statement(spark):
    """Every statement with as many random edits as it may have is found, with its true distance or less."""
    pick, rows, expected = random.Random(13), [], {}
    for label, text, must in license_scan.STATEMENTS:
        for n in range(6):
            found, edits = text.split(), int(license_scan.EDITS * len(text.split()))
            for _ in range(edits):
                i = pick.randrange(len(found))
                found[i : i + pick.choice((0, 1))] = pick.choice(([], ["zz"]))
            if not license_scan.holds(found, must.split()):
                continue
            rows.append((len(rows), " ".join(["pad"] * n + found + ["pad"] * 3), "en", "s", 0))
            expected[len(rows) - 1] = label, 1 - edits / len(text.split())
    found = {r.key: r for r in license_scan.scan(corpus.frame(spark, rows)).collect()}
    for key, (label, score) in expected.items():
        assert label in found[key].labels.split(",") and found[key].score >= score - 1e-9


def test_distances_are_edit_distances():
    pick = random.Random(14)
    for _ in range(50):
        a, b = ([pick.randrange(3) for _ in range(pick.randrange(1, 8))] for _ in range(2))
        table = [[0] * (len(b) + 1)]
        for i, x in enumerate(a, 1):
            table.append([i])
            for j, y in enumerate(b, 1):
                table[-1].append(min(table[i - 1][j - 1] + (x != y), table[i - 1][j] + 1, table[i][j - 1] + 1))
        assert license_scan.distances(np.array(a), np.array(b)).tolist() == table[-1]


# --- words and bitmaps -------------------------------------------------------


def test_words_of_batches():
    texts = [None, "", "  a B,c", "é ab", "x" * 5000 + " y", "Q"]
    found = words.find(pa.array(texts, pa.string()), words.kinds(words.IN_WORD, blank=b" ", border=b","))
    assert [found.word(j).decode() for j in range(len(found.start))] == ["a", "b", "c", "é", "ab", "x" * 5000, "y", "q"]
    assert found.counts().tolist() == [0, 0, 3, 2, 2, 1] and found.follows.tolist() == [True, False, False, True, False, True, False, False]
    keys = words.hashes(found, 3)
    again = words.find(pa.array(["y é", "ab " + "x" * 5000], pa.string()).slice(1), words.kinds(words.IN_WORD, blank=b" "))
    assert words.hashes(again, 3).tolist() == keys[[4, 5]].tolist() and len(set(keys.tolist())) == len(keys)


def test_bitmap_finds_all_keys(spark):
    keys = np.random.default_rng(5).integers(0, 2**64, 3000, dtype=np.uint64)
    frame = spark.createDataFrame([(k,) for k in keys.view(np.int64).tolist()], "k long")
    bitmap = key_filter.bitmap_of(frame, "k").value
    assert key_filter.maybe_in(bitmap, keys).all()
    others = np.random.default_rng(6).integers(0, 2**64, 3000, dtype=np.uint64)
    assert key_filter.maybe_in(bitmap, others).sum() < 10
