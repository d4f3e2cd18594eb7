"""License scans by diagonal voting.

Licenses are known by templates, sequences of words. Every three words in a row of
every text are hashed and joined with the places of templates that hold the same
three; each match is a vote for the diagonal (place in the text less place in the
template). Votes are summed up by diagonal, and diagonals that lie as near
together as a template's allowed edits can move them are merged. Clusters with
fewer votes than those edits can leave are no occurrence of it. The others are
verified against the words of the text: a template of no edits word for word, any
other by its edit distance from the best span.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import key_filter, words
from tillflow.llm.common import record_batch, shipped, stored

# A word, and the phrases that count by themselves, with their labels.
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Statements and opening words of public licenses. Label, template, and the words without which it is another license.
STATEMENTS = (
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "attribution 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "attribution noncommercial 4"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "attribution sharealike 4"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", "version 3"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "without restriction"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
)
# Words of a gram, the share of a template's words that may be edited, and the seed of word hashes.
GRAM, EDITS, SEED = 3, 0.2, 13
# Templates are broadcast: no more words than this.
TEMPLATE_WORDS = 200_000
# What stands before a text's grams, so that every text meets one row of the join.
HEAD = -1

KINDS = words.kinds(words.BLANK, word=WORD_BYTES)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    must: tuple[str, ...]
    base: bool

    @property
    def edits(self) -> int:
        return 0 if self.base else int(EDITS * len(self.words))

    @property
    def least_votes(self) -> int:
        """An edit spoils at most GRAM grams."""
        return max(1, len(self.words) - GRAM + 1 - GRAM * self.edits)


def templates(base=BASE, statements=STATEMENTS) -> list[Template]:
    found = [Template(label, tuple(text.split()), (), True) for label, text in base]
    found += [Template(label, tuple(text.split()), tuple(must.split()), False) for label, text, must in statements]
    if any(len(t.words) < GRAM for t in found):
        raise ValueError(f"a template needs {GRAM} words at least")
    if sum(len(t.words) for t in found) > TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {TEMPLATE_WORDS} words are not broadcast")
    return found


def grams_of(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all grams inside texts, and the text of each."""
    grams = words.gram_hashes(words.hashes(found, SEED), GRAM)
    whole = found.text[: len(grams)] == found.text[GRAM - 1 :] if len(grams) else np.zeros(0, bool)
    return grams[whole].view(np.int64), found.text[: len(grams)][whole]


def template_places(spark, known: list[Template]) -> DataFrame:
    found = words.find(pa.array([" ".join(t.words) for t in known], pa.string()), KINDS)
    grams, owner = grams_of(found)
    rows, seen = [(HEAD, -1, 0, 0, 0)], {}
    for gram, at in zip(grams.tolist(), owner.tolist()):
        rows.append((gram, at, seen.get(at, 0), known[at].edits, known[at].least_votes))
        seen[at] = seen.get(at, 0) + 1
    return spark.createDataFrame(rows, "gram long, template int, t_place int, edits int, least int")


def mark(key: str, text: str) -> Column:
    """One value for what a row's result depends on: its key and its text."""
    return F.unhex(F.sha2(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("-")), F.coalesce(F.col(text), F.lit(""))), 256))


def with_grams(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, mark, n_words, and the text's grams behind a leading HEAD."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = words.find(batch["text"], KINDS)
            grams, owner = grams_of(found)
            sizes = np.bincount(owner, minlength=found.texts) + 1
            ends = np.concatenate([[0], np.cumsum(sizes)])
            values = np.full(ends[-1], HEAD, dtype=np.int64)
            inner = np.ones(len(values), dtype=bool)
            inner[ends[:-1]] = False
            values[inner] = grams
            yield record_batch([
                ("key", batch["key"].type, batch["key"]), ("mark", pa.binary(), batch["mark"]),
                ("n_words", pa.int64(), found.counts()),
                ("grams", pa.list_(pa.int64()), pa.ListArray.from_arrays(ends.astype(np.int32), values)),
            ])

    slim = docs.select(F.col(key).alias("key"), mark(key, text).alias("mark"), F.col(text).alias("text"))
    return shipped(slim).mapInArrow(run, f"key {kind}, mark binary, n_words long, grams array<long>")


def clusters(votes: DataFrame) -> DataFrame:
    """Merged diagonals (mark, template, low, high) that have votes enough; a row that repeats votes once."""
    diagonals = votes.groupBy("mark", "template", "edits", "least", (F.col("place") - F.col("t_place")).alias("diagonal")).agg(
        F.size(F.collect_set("t_place")).alias("votes")
    )
    along = Window.partitionBy("mark", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("edits"), F.lit(True))
    return (
        diagonals.withColumn("apart", apart.cast("int")).withColumn("cluster", F.sum("apart").over(along))
        .groupBy("mark", "template", "cluster", "least")
        .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"))
        .filter("votes >= least").select("mark", "template", "low", "high")
    )


def distances(template: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Edits that turn the whole template into words that end before place 0, 1, … of the span, wherever they begin."""
    steps = np.arange(len(span) + 1)
    row = np.zeros(len(span) + 1, dtype=np.int64)
    for i, word in enumerate(template, 1):
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (span != word))
        best[0] = i
        row = np.minimum.accumulate(best - steps) + steps
    return row


def holds(where: list, phrase: list) -> bool:
    return any(where[i : i + len(phrase)] == phrase for i in range(len(where) - len(phrase) + 1))


@cache
def vocabulary(known: tuple[Template, ...]) -> dict[bytes, int]:
    return {word: i for i, word in enumerate(sorted({w.encode() for t in known for w in t.words + t.must}))}


def verified(known: tuple[Template, ...], found: words.Words, first: int, count: int, spans: list[dict]) -> dict:
    """What the words `first` to `first + count` of `found` hold of the spans' templates."""
    ids = vocabulary(known)
    number = lambda text: [ids[w.encode()] for w in text]
    places, base, best = [], set(), {}
    for span in spans:
        template = known[span["template"]]
        low, high = max(0, span["low"] - template.edits), min(count, span["high"] + len(template.words) + template.edits)
        if template.base:
            own = [found.word(first + j).decode() for j in range(low, high)]
            if own == list(template.words):
                places.append(low)
                base.add(template.label)
            continue
        if best.get(template.label) == 1.0:
            continue
        own = [ids.get(found.word(first + j), -1) for j in range(low, high)]
        row = distances(np.array(number(template.words)), np.array(own, dtype=np.int64))
        for end in np.flatnonzero(row <= template.edits):
            near = own[max(0, end - len(template.words) - template.edits) : end]
            score = 1 - int(row[end]) / len(template.words)
            if score > best.get(template.label, 0) and holds(near, number(template.must)):
                best[template.label] = score
    for label in base:
        best[label] = 1.0
    return {
        "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(best)), "score": max(best.values(), default=0.0),
    }


RESULT = [
    ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, statements=STATEMENTS) -> DataFrame:
    """One row for each row of `docs`: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    `n_base` counts all places at which the words of a phrase of `base` stand in a row,
    also overlapping ones; the first and last of them are given by the number of
    their first word. `labels` adds those of templates in `statements` that a span of
    words matches with at most a fifth of the template's words edited, its telling
    words unchanged. `score` is the share of unedited words of the best match: 1 for a
    phrase of `base`, 0 without any label. Equal labels count once.

    A null text has no words, like an empty one; rows that repeat get equal
    results. An empty table gives an empty result; further columns are not read.
    """
    known = tuple(templates(base, statements))
    places = F.broadcast(template_places(docs.sparkSession, list(known)))
    grams = with_grams(docs, key, text).select("key", "mark", "n_words", F.posexplode("grams").alias("at", "gram"))
    # One row for every text, and one for every match.
    votes = stored(
        grams.join(places, "gram").filter("(template = -1) = (at = 0)")
        .select("key", "mark", "n_words", (F.col("at") - 1).alias("place"), "template", "t_place", "edits", "least"),
        "license-votes",
    )
    spans = stored(clusters(votes.filter("template >= 0")), "license-spans")
    of_mark = spans.groupBy("mark").agg(F.collect_list(F.struct("template", "low", "high")).alias("spans"))
    results = stored(_verify(_texts_of(docs, key, text, spans).join(of_mark, "mark"), known), "license-results")
    rows = votes.filter("template = -1").select("key", "mark", "n_words").join(results, "mark", "left")
    return rows.select(
        "key", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _texts_of(docs: DataFrame, key: str, text: str, spans: DataFrame) -> DataFrame:
    """mark and text of the rows that may have spans; each mark once."""
    bits = F.xxhash64("mark")
    wanted = key_filter.bitmap_of(spans.select(bits.alias("bits")), "bits")

    def run(batches):
        for batch in batches:
            keep = key_filter.maybe_in(wanted.value, batch["bits"].to_numpy().view(np.uint64))
            yield batch.select(["mark", "text"]).filter(pa.array(keep))

    rows = docs.select(mark(key, text).alias("mark"), F.col(text).alias("text")).withColumn("bits", bits)
    return shipped(rows).mapInArrow(run, "mark binary, text string").dropDuplicates(["mark"])


def _verify(rows: DataFrame, known: tuple[Template, ...]) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = words.find(batch["text"], KINDS)
            counts = found.counts()
            firsts = np.cumsum(counts) - counts
            made = [
                verified(known, found, int(first), int(count), spans)
                for first, count, spans in zip(firsts, counts, batch["spans"].to_pylist())
            ]
            columns = [(name, kind, [m[name] for m in made]) for name, kind in RESULT]
            yield record_batch([("mark", pa.binary(), batch["mark"]), *columns])

    schema = "mark binary, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return shipped(rows.select("mark", "text", "spans")).mapInArrow(run, schema)
