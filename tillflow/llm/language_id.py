"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds those of
its letters, permuted by their place, by multiplying them; a text's vector bundles
the vectors of its trigrams by adding them. A language's prototype bundles all its
texts, and a text takes the language whose prototype is nearest by cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import record_batch, shipped

DIMENSIONS = 1024
SEED = 4177
# Signs that a worker takes at a time, trigram and letter vectors that it keeps, trigrams whose vectors it adds up
# at a time, and texts' trigrams likewise: with an alphabet of any size it holds no more.
SLICE_SIGNS = 1_000_000
VECTORS_KEPT, LETTERS_KEPT = 30_000, 20_000
TRIGRAMS_AT_ONCE, ENTRIES_AT_ONCE = 2048, 8192
UNKNOWN = "und"
BLANK = 32


class Space:
    """Letter and trigram vectors; the same in every worker, whatever it has seen."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[tuple, int] = {}
        self.rows = np.zeros((VECTORS_KEPT, dimensions), np.int8)
        self.is_letter = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.bool_)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= LETTERS_KEPT:
                self.letters.clear()
            random = np.random.Generator(np.random.PCG64([SEED, code]))
            self.letters[code] = (random.integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)
        return self.letters[code]

    def vectors(self, grams: list[tuple]) -> np.ndarray:
        """The vectors of at most VECTORS_KEPT trigrams of code points; the kept ones are reused."""
        missing = [g for g in grams if g not in self.row]
        if len(self.row) + len(missing) > VECTORS_KEPT:
            self.row.clear()
            missing = grams
        if missing:
            first = len(self.row)
            a, b, c = (np.stack([self.letter(g[i]) for g in missing]) for i in range(3))
            self.rows[first : first + len(missing)] = np.roll(a, 2, 1) * np.roll(b, 1, 1) * c
            self.row.update((g, first + i) for i, g in enumerate(missing))
        return self.rows[[self.row[g] for g in grams]]

    def bound(self, gram: tuple) -> np.ndarray:
        a, b, c = gram
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def signs(self, text: str | None) -> np.ndarray:
        """Code points of the lower-cased text, all but letters as one blank, a blank at both ends; empty without letters."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        letter = self.is_letter[codes]
        if not letter.any():
            return codes[:0]
        codes = np.concatenate([[BLANK], np.where(letter, codes, BLANK), [BLANK]]).astype(np.uint32)
        return codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])]

    def bundles(self, texts: list[np.ndarray], group: np.ndarray, groups: int) -> np.ndarray:
        """For each group the sum of the trigram vectors of its texts (given as signs)."""
        total = np.zeros((groups, self.dimensions))
        pieces, length = [], 0
        for signs, g in zip(texts, group):
            for begin in range(0, max(len(signs) - 2, 0), SLICE_SIGNS):
                piece = signs[begin : begin + SLICE_SIGNS + 2]
                pieces.append((piece, g))
                length += len(piece)
                if length >= SLICE_SIGNS:
                    self._add(total, pieces)
                    pieces, length = [], 0
        if pieces:
            self._add(total, pieces)
        return total

    def _add(self, total: np.ndarray, pieces: list) -> None:
        codes, numbers = np.unique(np.concatenate([p for p, _ in pieces]), return_inverse=True)
        n, ends = len(codes), np.cumsum([len(p) for p, _ in pieces])
        grams = (numbers[:-2] * n + numbers[1:-1]) * n + numbers[2:]
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p, _ in pieces])[:-2]
        inside = np.ones(len(grams), bool)
        for back in (2, 1):  # trigrams that would cross from one piece to the next
            at = ends[:-1] - back
            inside[at[at < len(grams)]] = False
        grams, owner = grams[inside], owner[inside]
        kinds, column = np.unique(grams, return_inverse=True)
        owners = sorted({g for _, g in pieces})
        line = np.searchsorted(owners, [g for _, g in pieces])[owner]
        # How often each text has each trigram, by trigram.
        pairs, times = np.unique(column * len(owners) + line, return_counts=True)
        columns, lines = pairs // len(owners), pairs % len(owners)
        owners = np.array(owners)
        for begin in range(0, len(kinds), TRIGRAMS_AT_ONCE):
            here = kinds[begin : begin + TRIGRAMS_AT_ONCE]
            spelled = zip(codes[here // (n * n)].tolist(), codes[here // n % n].tolist(), codes[here % n].tolist())
            vectors = self.vectors(list(spelled)).astype(np.float32)
            low, high = np.searchsorted(columns, [begin, begin + len(here)])
            at, who, often = columns[low:high] - begin, lines[low:high], times[low:high].astype(np.float32)
            # Sums of whole numbers below 2**24 are exact in single precision.
            if len(at) * 16 >= len(owners) * len(here):
                counts = np.zeros((len(owners), len(here)), np.float32)
                counts[who, at] = often
                total[owners] += counts @ vectors
                continue
            order = np.argsort(who, kind="stable")
            for first in range(0, len(order), ENTRIES_AT_ONCE):
                some = order[first : first + ENTRIES_AT_ONCE]
                heads = np.flatnonzero(np.concatenate([[True], who[some][1:] != who[some][:-1]]))
                total[owners[who[some][heads]]] += np.add.reduceat(vectors[at[some]] * often[some][:, None], heads)


_spaces: dict[int, Space] = {}


def space(dimensions: int) -> Space:
    if dimensions not in _spaces:
        _spaces[dimensions] = Space(dimensions)
    return _spaces[dimensions]


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The bundle of every language of `labelled` (text, lang): dimensions whole numbers a language.

    A task gives one bundle for each language it meets; the sums by language and
    dimension are Spark's, and only they go to the driver.
    """

    def work(batches):
        own, sums = space(dimensions), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            texts = [own.signs(t) for t in batch.column(0).to_pylist()]
            found = own.bundles(texts, np.array([names.index(g) for g in langs], int), len(names))
            for name, bundle in zip(names, found):
                sums[name] = sums.get(name, 0) + bundle
        if sums:
            yield record_batch([
                ("lang", pa.string(), list(sums)),
                ("bundle", pa.list_(pa.int64()), [s.astype(np.int64).tolist() for s in sums.values()]),
            ])

    rows = (
        shipped(labelled).select("text", "lang").mapInArrow(work, "lang string, bundle array<long>")
        .select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    )
    found: dict[str, np.ndarray] = {}
    for row in rows:
        found.setdefault(row["lang"], np.zeros(dimensions))[row["i"]] = row["x"]
    return {lang: v for lang, v in sorted(found.items()) if np.any(v)}


def predicted(docs: DataFrame, profiles: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """key, held_out, lang_pred and score (the cosine, at least 0) of `docs` (key, text, held_out)."""
    names = list(profiles)
    unit = np.stack([v / np.linalg.norm(v) for v in profiles.values()]) if names else np.zeros((0, dimensions))

    def work(batches):
        own = space(dimensions)
        for batch in batches:
            texts = [own.signs(t) for t in batch.column(1).to_pylist()]
            bundles = own.bundles(texts, np.arange(len(texts)), len(texts))
            length = np.linalg.norm(bundles, axis=1)
            cosine = bundles @ unit.T / np.where(length > 0, length, 1)[:, None]
            best = cosine.argmax(1) if names else np.zeros(len(texts), int)
            known = [bool(names) and len(t) > 0 for t in texts]
            yield record_batch([
                ("key", pa.int64(), batch.column(0)), ("held_out", pa.bool_(), batch.column(2)),
                ("lang_pred", pa.string(), [names[b] if k else UNKNOWN for b, k in zip(best, known)]),
                ("score", pa.float64(), [
                    min(1.0, max(0.0, float(cosine[i, best[i]]))) if k else 0.0 for i, k in enumerate(known)
                ]),
            ])

    return shipped(docs).select("key", "text", "held_out").mapInArrow(work, "key long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5) -> DataFrame:
    """key, held_out, lang_pred and score of every row of `docs`.

    Learns from rows with a language whose crc32(key as text) mod `folds` is not 0;
    the others are held out, rows with a null key among them. A text that is null
    or has no letter is `und` with score 0, and so is every text if nothing was
    learned. Cosines that tie take the first language by code point. Repeated rows
    are rows of their own; an empty table gives an empty result; further columns
    are not read.
    """
    fold = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"),
        (F.col(key).isNull() | (fold == 0)).alias("held_out"),
    )
    learned = prototypes(rows.filter("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL"))
    return predicted(rows, learned)
