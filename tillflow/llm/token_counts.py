"""Token counts by a finite-state transducer that is compiled from a tokenizer file.

The transducer reads normalised text sign by sign, and every transition carries
the tokens it emits: the count at the new place less the count at the last one.
Inside a word a state holds what the next places can depend on: the longest read
ending that a token may still begin with and, for each place inside it, the last
token there and how many tokens it lies behind. Contractions add a few states
that wait for the next sign. States are compiled when they are first reached.

A text is cut into chunks. A chunk's state map is what it does to any state: the
signs before its first blank still depend on the state before, the blank resets
the machine, what follows counts a fixed number, and the open end is the state
left behind. Maps compose pairwise to the map of the whole text. Head and tail
are signs, not states: a text without a blank is one head as long as the text, and
is counted in one run at the end.
"""

from __future__ import annotations

import json
import re
import unicodedata
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import arrow_map, record_batch

CHUNK_SIGNS = 1 << 16
# Bounds of a worker's memos: states, border tests, and words in each of two generations.
STATES_KEPT, PAIRS_KEPT, WORDS_KEPT = 200_000, 400_000, 300_000
END = "\n"  # closes a word; no byte is spelled with it
FROM_START = -1
# The contractions that are words of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# Signs that can only be a run of others after letters.
MARKS = frozenset(".,;:!?)|")
BLANK = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def byte_signs() -> list[str]:
    """The sign that byte-level vocabularies use for each byte: itself if printable, else the next free one from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Borders:
    """Which tokens may stand side by side, from ranked merges of pairs."""

    def __init__(self, ranks: dict[tuple[str, str], int], signs: list[str]):
        self.ranks = ranks
        self.made = dict.fromkeys([*signs, *(s + END for s in signs)], FROM_START)
        self.parts: dict[str, tuple[str, str]] = {}
        for pair in ranks:
            token = pair[0] + pair[1]
            if token not in self.made and (last := self.last_merge(token)):
                self.made[token], self.parts[token] = ranks[last], last
        self.starts = {token[:i] for token in self.made for i in range(len(token) + 1)}
        self.known: dict[tuple[str, str], bool] = {}

    def last_merge(self, token: str) -> tuple[str, str] | None:
        parts = list(token)
        if parts[-1] == END:
            parts[-2:] = [parts[-2] + END]
        pair = None
        while len(parts) > 1:
            due = [(self.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
            if not due:
                return None
            at = min(due)[1]
            pair = parts[at], parts[at + 1]
            parts[at : at + 2] = [pair[0] + pair[1]]
        return pair

    def test(self, left: str, right: str) -> bool:
        """Whether merging the signs of both ends with these two tokens.

        Their merges are taken back, the latest first; a pair that meets at the
        border and is due before the merge just taken back would have won.
        """
        if (left, right) in self.ranks:
            return False
        while True:
            by_left, by_right = self.made[left], self.made[right]
            if by_right >= by_left:
                if by_right == FROM_START:
                    return True
                right = self.parts[right][0]
                if self.ranks.get((left, right), by_right + 1) <= by_right:
                    return False
            else:
                left = self.parts[left][1]
                if self.ranks.get((left, right), by_left) < by_left:
                    return False

    def may_meet(self, left: str, right: str) -> bool:
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) >= PAIRS_KEPT:
                self.known.clear()
            found = self.known[left, right] = self.test(left, right)
        return found


class State:
    """A state of the word machine and its compiled transitions: sign -> (state, tokens emitted)."""

    __slots__ = ("ending", "places", "moves")

    def __init__(self, ending: str, places: tuple):
        self.ending, self.places, self.moves = ending, places, {}


class WordMachine:
    """Counts the tokens of one word given sign by sign, then END."""

    def __init__(self, borders: Borders):
        self.borders = borders
        self.states: dict[tuple, State] = {}
        self.start = self.state("", ((None, 0),))

    def state(self, ending: str, places: tuple) -> State:
        found = self.states.get((ending, places))
        if found is None:
            if len(self.states) >= STATES_KEPT:
                self.forget()
            found = self.states[ending, places] = State(ending, places)
        return found

    def forget(self) -> None:
        """Drop all compiled states, at any sign of a word: whoever is in one goes on from it, and compiles what follows anew."""
        for state in self.states.values():
            state.moves.clear()
        self.states = {(self.start.ending, self.start.places): self.start}

    def step(self, state: State, sign: str) -> tuple[State, int]:
        move = state.moves.get(sign)
        if move is None:
            move = state.moves[sign] = self.compiled(state, sign)
        return move

    def compiled(self, state: State, sign: str) -> tuple[State, int]:
        borders, read = self.borders, state.ending + sign
        for begin, (last, behind) in enumerate(state.places):
            token = read[begin:]
            if token in borders.made and (last is None or borders.may_meet(last, token)):
                emitted = behind + 1
                break
        if sign == END:
            return self.start, emitted
        ending = read
        while ending not in borders.starts:
            ending = ending[1:]
        kept = state.places[len(read) - len(ending):] if ending != read else state.places
        return self.state(ending, (*((t, b - emitted) for t, b in kept), (token, 0))), emitted


class ChunkMap(NamedTuple):
    """What a chunk does: `head` joins the state before it; None for `tail`: the chunk has no blank."""

    head: str
    count: int
    tail: str | None


class Transducer:
    """The tokenizer of one file: normaliser, words, merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"]["end_of_word_suffix"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        ranks = {}
        for rank, pair in enumerate(pairs):
            ranks.setdefault(tuple(END.join(t.rsplit(suffix, 1)) if t.endswith(suffix) else t for t in pair), rank)
        self.signs = byte_signs()
        self.words = WordMachine(Borders(ranks, self.signs))
        marks = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(marks)) if marks else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def spelled(self, sign: str) -> str:
        return "".join(self.signs[b] for b in sign.encode())

    def run(self, state: State, text: str) -> tuple[State, int]:
        emitted = 0
        for sign in self.spelled(text):
            state, more = self.words.step(state, sign)
            emitted += more
        return state, emitted

    def closed(self, text: str) -> int:
        """Tokens of one whole word."""
        machine = self.words
        state, emitted = machine.start, 0
        for sign in text if text.isascii() else self.spelled(text):
            move = state.moves.get(sign) or machine.step(state, sign)
            state = move[0]
            emitted += move[1]
        return emitted + machine.step(state, END)[1]

    def stretch(self, text: str) -> int:
        """Tokens of signs without a blank: letters, numbers one by one, runs of others, contractions."""
        if text.isalpha():
            return self.closed(text)
        if text[-1] in MARKS and text[:-1].isalpha():
            return self.counted(text[:-1]) + self.closed(text[-1])
        machine, state, emitted, kind, waiting = self.words, self.words.start, 0, None, ""
        for sign in text:
            category = unicodedata.category(sign)[0]
            now = category if category in "LN" else "O"
            if waiting:
                waiting += sign
                if waiting in CONTRACTIONS:
                    emitted, kind, waiting = emitted + self.closed(waiting), None, ""
                    continue
                if any(c.startswith(waiting) for c in CONTRACTIONS):
                    continue
                # No contraction: the apostrophe opens a run of others, and the letters read since are a word.
                state, more = self.run(machine.start, "'")
                emitted, kind, letters, waiting = emitted + more, "O", waiting[1:-1], ""
                if letters:
                    emitted += machine.step(state, END)[1]
                    state, more = self.run(machine.start, letters)
                    emitted, kind = emitted + more, "L"
            if kind is not None and (now != kind or now == "N"):
                emitted += machine.step(state, END)[1]
                state, kind = machine.start, None
            if sign == "'" and kind is None:
                waiting = sign
                continue
            state, more = self.run(state, sign)
            emitted, kind = emitted + more, now
        if waiting:
            emitted, kind = emitted + self.closed("'") + (self.closed(waiting[1:]) if waiting[1:] else 0), None
        return emitted + (machine.step(state, END)[1] if kind is not None else 0)

    def counted(self, text: str) -> int:
        """`stretch`, remembered."""
        found = self.known.get(text)
        if found is None:
            found = self.older.get(text)
            if found is None:
                found = self.stretch(text)
            if len(text) <= 64:
                self.known[text] = found
                if len(self.known) > WORDS_KEPT:
                    self.older, self.known = self.known, {}
        return found

    def normalised(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # sign by sign: no form for the end of a word

    def chunk_map(self, chunk: str) -> ChunkMap:
        first, *middle = BLANK.sub(" ", chunk).split(" ")
        if not middle:
            return ChunkMap(first, 0, None)
        tail = middle.pop()
        return ChunkMap(first, sum([self.counted(w) for w in middle if w]), tail)

    def composed(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        met = a.tail + b.head
        return ChunkMap(a.head, a.count + (self.counted(met) if met else 0) + b.count, b.tail)

    def folded(self, maps: list[ChunkMap]) -> ChunkMap:
        """The composition of all maps, neighbours first: no prefix is kept, so the maps never hold more than the text."""
        while len(maps) > 1:
            pairs = zip(maps[::2], maps[1::2])
            maps = [*(self.composed(a, b) for a, b in pairs), *maps[len(maps) - len(maps) % 2 :]]
        return maps[0]

    def total(self, whole: ChunkMap) -> int:
        return whole.count + sum(self.counted(w) for w in (whole.head, whole.tail) if w)

    def count(self, text: str, chunk_signs: int = CHUNK_SIGNS) -> int:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.count(p, chunk_signs) for p in parts if p)
        text = self.normalised(text)
        cuts = range(0, len(text), chunk_signs)
        maps = [self.chunk_map(text[i : i + chunk_signs]) for i in cuts]
        return self.total(self.folded(maps)) if maps else 0


_transducers: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of a tokenizer file, one in each worker."""
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes and n_tokens of every row of `docs`.

    A null text counts as empty: no bytes, no tokens. Special tokens spelled out
    in a text are one token, as the tokenizer's library has it. Null keys and
    repeated rows stay; an empty table gives an empty result; further columns are
    not read; whole texts are counted, however long.
    """

    def work(batch):
        own = transducer(path)
        return record_batch([
            ("key", pa.int64(), batch.column(0)), ("n_bytes", pa.int64(), batch.column(2)),
            ("n_tokens", pa.int64(), [own.count(t) if t else 0 for t in batch.column(1).to_pylist()]),
        ])

    n_bytes = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes")
    return arrow_map(docs.select(F.col(key).cast("long"), F.col(text), n_bytes), work, "key long, n_bytes long, n_tokens long")
