"""SentencePiece encoding and decoding by a prefix table.

For every prefix of a text the last token of its encoding is unique. The table is
filled from left to right: an Aho-Corasick automaton names the pieces that end at
a place, and the one that may follow the last token of the prefix before it is
the last token here. Two tokens may follow each other if merging their joined
text gives just these two. The ids are then read backwards through the table.
The time is linear in the text, and no queue of merges is kept.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import string
from itertools import chain, groupby

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import arrow_map, record_batch

# Fixed value: the sign that stands for a space.
SPACE = "▁"
# Bounds of a task's memos: chunks in each of two generations, pairs.
CHUNKS_KEPT, PAIRS_KEPT = 250_000, 400_000
# A longer chunk is unlikely to come again and is not kept.
LONGEST_KEPT = 64
FROM_START = float("inf")

codecs.register_error("each byte", lambda e: ("�", e.start + 1))


class Codec:
    """The encoder and decoder of one model file of merge type without user-defined pieces."""

    def __init__(self, model: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(library.vocab_size())
        self.bytes_ids: dict[int, int] = {}
        self.score: dict[str, float] = {}
        self.piece_id: dict[str, int] = {}
        self.decoded: list[bytes] = []
        self.silent = {i for i in ids if library.is_control(i)}
        for i in ids:
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes_ids[int(piece[3:5], 16)] = i
                self.decoded.append(bytes([int(piece[3:5], 16)]))
            elif library.is_unknown(i):
                self.unknown = i
                self.decoded.append(" ⁇ ".encode())
            elif i in self.silent:
                self.decoded.append(b"")
            else:
                self.piece_id[piece], self.score[piece] = i, library.get_score(i)
                self.decoded.append(piece.replace(SPACE, " ").encode())
        self.starts_blank = {i for p, i in self.piece_id.items() if p.startswith(SPACE)}
        probe = "  Ａ b　́e  "
        self.prefix = SPACE if library.normalize("a").startswith(SPACE) else ""
        plain = library.normalize(probe) == self.prefix + probe.replace(" ", SPACE)
        self.normalize = self._plain if plain else library.normalize
        letters = sorted({c for piece in self.piece_id for c in piece})
        # How a token is made: the two parts of its last merge, and that merge's score. Pieces that merging
        # cannot make never occur. Single signs are there from the start, also those without a piece.
        self.parts = {p: pair for p in self.piece_id if len(p) > 1 and (pair := self.last_merge(p))}
        self.made = {p: self.score[p] for p in self.parts} | dict.fromkeys(letters, FROM_START)
        self.ids_of = {t: [self.piece_id[t]] if t in self.piece_id else self.spell(t) for t in self.made}
        self.automaton = ahocorasick.Automaton()
        for text in self.made:
            self.automaton.add_word(text, text)
        self.automaton.make_automaton()
        # No piece crosses a place before the space sign, nor one beside a sign that no piece holds.
        if any(SPACE in piece.lstrip(SPACE) for piece in self.piece_id):
            self.chunks = re.compile(".+", re.DOTALL)
        elif "\n" in letters:
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            # Nor between a letter and a punctuation mark that no piece has after a letter.
            inside = {m for p in self.piece_id for m in re.findall(r"(?<=[^\W\d_])\W", p)}
            marks = "".join(re.escape(c) for c in string.punctuation if c not in inside and c != "_")
            word = f"{SPACE}*[^\\W\\d_]+(?=[{marks}])|" if marks else ""
            self.chunks = re.compile(f"\n|{word}{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        inner = "".join(re.escape(c) for c in letters)
        self.spans = re.compile(f"[{inner}]+|[^{inner}]")
        self.letters = set(letters)
        self.follows: dict[tuple[str, str], bool] = {}
        # Two generations: what is used again moves to the younger, the older is dropped when that is full.
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _plain(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def spell(self, text: str) -> list[int]:
        """A sign without a piece: its bytes, or the unknown id if the model has none."""
        if not self.bytes_ids:
            return [self.unknown]
        return [self.bytes_ids[b] for b in text.encode()]

    def last_merge(self, text: str) -> tuple[str, str] | None:
        """The two parts whose merge makes `text`, if merging its signs makes it: best piece first, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(l + r) for l, r in zip(parts, parts[1:])]
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                return None
            at = scores.index(best)
            pair = parts[at], parts[at + 1]
            parts[at : at + 2] = [pair[0] + pair[1]]
        return pair

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging the signs of left + right ends with these two tokens.

        The merges that made the two are taken back, the latest first. If ever the
        pieces that then meet at the border make a piece that is due before the
        merge just taken back, the border would have been merged away.
        """
        score, parts = self.score, self.parts
        if left + right in score:
            return False
        while True:
            by_left, by_right = self.made[left], self.made[right]
            if by_right <= by_left:
                if by_right == FROM_START:
                    return True
                right = parts[right][0]
                met = score.get(left + right)
                if met is not None and met >= by_right:
                    return False
            else:
                left = parts[left][1]
                met = score.get(left + right)
                if met is not None and met > by_left:
                    return False

    def encode_chunk(self, chunk: str) -> list[int]:
        if self.letters.issuperset(chunk):
            return self.encode_span(chunk)
        spans = self.spans.findall(chunk)
        return list(chain.from_iterable(
            self.encode_span(s) if s[0] in self.letters else self.spell(s) for s in spans
        ))

    def encode_span(self, chunk: str) -> list[int]:
        """The ids of signs that all occur in pieces."""
        follows = self.follows
        last: list[str | None] = [None] * len(chunk)
        for end, token in self.automaton.iter(chunk):
            if last[end] is None:
                before = end - len(token)
                if before < 0:
                    last[end] = token
                    continue
                left = last[before]
                if left is not None:
                    pair = left, token
                    fits = follows.get(pair)
                    if fits is None:
                        if len(follows) >= PAIRS_KEPT:
                            follows.clear()
                        fits = follows[pair] = self.may_follow(left, token)
                    if fits:
                        last[end] = token
        at, ids = len(chunk) - 1, []
        while at >= 0:
            token = last[at]
            ids.append(self.ids_of[token])
            at -= len(token)
        ids.reverse()
        return list(chain.from_iterable(ids))

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        for c in self.chunks.findall(self.normalize(text)):
            found = known.get(c)
            if found is None:
                found = self.older.pop(c, None) or self.encode_chunk(c)
                if len(c) <= LONGEST_KEPT:
                    known[c] = found
            ids += found
        if len(known) > CHUNKS_KEPT:
            self.older, self.known = known, {}
        return ids

    def forget(self) -> None:
        """Empty the memos."""
        self.known, self.older = {}, {}
        self.follows.clear()

    def decode(self, ids: list[int]) -> str:
        raw = self.decoded
        if not self.silent.isdisjoint(ids):  # a control id ends a run of bytes
            runs, spoken = [], [i for i in ids if i not in self.silent]
            for silent, run in groupby(ids, self.silent.__contains__):
                runs += [] if silent else [b"".join([raw[i] for i in run]).decode("utf-8", "each byte")]
            text = "".join(runs)
            return text[1:] if self.prefix and spoken and spoken[0] in self.starts_blank else text
        text, first = b"".join([raw[i] for i in ids]), ids[0] if ids else None
        if self.prefix and first in self.starts_blank:
            text = text[1:]
        return text.decode("utf-8", "each byte")


_codecs: dict[str, Codec] = {}


def codec(model: str) -> Codec:
    """The codec of a model file, built once in each worker."""
    if model not in _codecs:
        _codecs[model] = Codec(model)
    return _codecs[model]


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids and the text decoded from them, for every row of `docs`.

    A null or empty text has no ids and decodes to the empty text; null keys and
    repeated rows stay as they are; an empty table gives an empty result; further
    columns are not read. Texts that the model cannot spell come back with its
    unknown sign. Nothing is cut, however long.
    """

    def work(batch):
        own = codec(model)
        ids = [own.encode(t) if t else [] for t in batch.column(1).to_pylist()]
        return record_batch([
            ("key", pa.int64(), batch.column(0)), ("ids", pa.list_(pa.int32()), ids),
            ("decoded", pa.string(), [own.decode(i) for i in ids]),
        ])

    return arrow_map(docs.select(F.col(key).cast("long"), F.col(text)), work, "key long, ids array<int>, decoded string", lambda: codec(model).forget())


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and the sha256 of ids and decoded text; what encode_decode gives, without moving it."""

    def work(batch):
        own, numbers = codec(model), []
        sign = [str(i) for i in range(len(own.decoded))]
        for t in batch.column(1).to_pylist():
            ids = own.encode(t) if t else []
            joined = ",".join([sign[i] for i in ids])
            numbers.append((
                len(ids), hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(own.decode(ids).encode()).hexdigest(),
            ))
        return record_batch([
            ("key", pa.int64(), batch.column(0)), ("n_tokens", pa.int64(), [n[0] for n in numbers]),
            ("ids_sha256", pa.string(), [n[1] for n in numbers]),
            ("decoded_sha256", pa.string(), [n[2] for n in numbers]),
        ])

    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(docs.select(F.col(key).cast("long"), F.col(text)), work, schema, lambda: codec(model).forget())


def with_ids(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with its text as decoded from its ids, and the ids as a further column.

    A null text stays null and has no ids. A column that has the name of the new one gives way to it.
    """
    docs = docs.drop(ids)
    at, schema = docs.columns.index(text), T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def work(batch):
        own = codec(model)
        found = [own.encode(t) if t else [] for t in batch.column(at).to_pylist()]
        texts = [None if t is None else own.decode(i) for t, i in zip(batch.column(at).to_pylist(), found)]
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, ids])

    return arrow_map(docs, work, schema, lambda: codec(model).forget())
