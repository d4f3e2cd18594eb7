"""Words of whole batches of texts as 64-bit numbers, worked out in numpy inside a task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What a byte is: part of a word, a blank between words, a border that no phrase crosses.
IN_WORD, BLANK, BORDER = 0, 1, 2
# Words of more bytes are hashed one by one; bytes of words that are hashed at a time.
LONG_WORD, SLICE_BYTES = 4096, 1 << 20

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32


def kinds(rest: int, word: bytes = b"", blank: bytes = b"", border: bytes = b"") -> np.ndarray:
    """What each of the 256 bytes is: as named, or else `rest`."""
    table = np.full(256, rest, dtype=np.uint8)
    table[list(word)] = IN_WORD
    table[list(blank)] = BLANK
    table[list(border)] = BORDER
    return table


@dataclass
class Words:
    """All words of a batch in order: bytes `data[start:end]`, the text's number, and whether the next word follows.

    `follows[j]` holds if word j + 1 is in the same text and no border lies between them.
    """

    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    follows: np.ndarray
    texts: int

    def word(self, j: int) -> bytes:
        return self.data[self.start[j] : self.end[j]].tobytes()

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.text, minlength=self.texts)


def find(texts: pa.Array | pa.ChunkedArray, table: np.ndarray) -> Words:
    """The words of `texts`, A to Z lower-cased; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    count = len(texts)
    _, offsets, content = texts.buffers()
    borders = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + count + 1] if count else np.zeros(1, np.int64)
    first, last = int(borders[0]), int(borders[-1])
    raw = np.frombuffer(content, dtype=np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    borders = borders - first
    data = _lower[raw]
    kind = table[data]
    inside = kind == IN_WORD
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    # Words end with their text.
    cuts = borders[(borders > 0) & (borders < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    text = np.searchsorted(borders, start, side="right") - 1
    follows = np.zeros(len(start), dtype=bool)
    if len(start) > 1:
        follows[:-1] = text[1:] == text[:-1]
        walls = np.flatnonzero(kind == BORDER)
        if len(walls):
            passed = np.searchsorted(walls, start)
            follows[:-1] &= passed[1:] == passed[:-1]
    return Words(data, text, start, end, follows, count)


@cache
def _numbers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A random number for every byte value, and an odd one for every place in a word."""
    draw = np.random.Generator(np.random.PCG64(seed))
    of_byte = draw.integers(0, 2**64, 256, dtype=np.uint64)
    return of_byte, draw.integers(0, 2**64, LONG_WORD, dtype=np.uint64) | np.uint64(1)


def mixed(keys: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    keys = keys ^ (keys >> np.uint64(30))
    keys = keys * np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(27)
    keys *= np.uint64(0x94D049BB133111EB)
    keys ^= keys >> np.uint64(31)
    return keys


def hashes(words: Words, seed: int) -> np.ndarray:
    """A 64-bit hash of every word."""
    import xxhash

    of_byte, of_place = _numbers(seed)
    length = words.end - words.start
    keys = np.zeros(len(length), dtype=np.uint64)
    short = np.flatnonzero(length <= LONG_WORD)
    sizes = length[short]
    total = np.cumsum(sizes)
    at = 0
    while at < len(short):
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + SLICE_BYTES, side="right")))
        n, heads = sizes[at:stop], (total[at:stop] - sizes[at:stop] - base)
        place = np.arange(int(total[stop - 1] - base)) - np.repeat(heads, n)
        letters = words.data[place + np.repeat(words.start[short[at:stop]], n)]
        keys[short[at:stop]] = np.add.reduceat(of_byte[letters] * of_place[place], heads)
        at = stop
    for j in np.flatnonzero(length > LONG_WORD):
        keys[j] = xxhash.xxh3_64_intdigest(words.data[words.start[j] : words.end[j]], seed=seed)
    return mixed(keys + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(keys: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` keys in a row, for each place at which so many are left."""
    count = max(0, len(keys) - size + 1)
    grams = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        grams = mixed(grams * np.uint64(0x9E3779B97F4A7C15) + keys[i : i + count])
    return grams
