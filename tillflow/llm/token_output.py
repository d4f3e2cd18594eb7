"""Token ids written in training order.

Texts are encoded and packed, with an end id after each, into sequences of fixed
length. Every sequence gets a slot of the training order through a keyed Feistel
network over its number: a permutation of the next power of four, walked along its
cycle until it falls below the number of sequences. A shard holds a range of slots
and is one file of records of equal stride, so a reader starts or resumes at any
slot by seeking. Spark's own writer commits the files; a record's last id is
written as its line separator.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import partitions, record_batch, shipped
from tillflow.sources import scratch

SEQUENCE = 1024  # ids of a record, the closing one among them
SHARD_SEQUENCES = 8192
ROUNDS = 6
KEY = 0x5EED


class Encoder:
    """Ordinary ids of a vocabulary of ranked byte strings; its size is the id that closes a text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.end = max(ranks.values()) + 1
        if self.end >= 1 << 16:
            raise ValueError("ids have to fit into two bytes")
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.library.encode_ordinary(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a vocabulary file, one in each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, pattern)
    return _encoders[path]


def feistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    """One pass of the network over numbers of 2 * half bits; with the keys reversed and halves swapped, its inverse."""
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for key in keys:
        mixed = (right + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
    return left << np.uint64(half) | right


def _walk(x: np.ndarray, size: int, turn) -> np.ndarray:
    x = turn(x.astype(np.uint64))
    while (outside := x >= np.uint64(size)).any():
        x[outside] = turn(x[outside])
    return x.astype(np.int64)


def _network(size: int, key: int) -> tuple[int, list[int]]:
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    random = np.random.Generator(np.random.PCG64(key))
    return half, [int(k) for k in random.integers(1, 2**62, ROUNDS)]


def slots_of(number: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Slots of sequence numbers 0 … size - 1."""
    half, keys = _network(size, key)
    return _walk(number, size, lambda x: feistel(x, half, keys))


def numbers_of(slot: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """The inverse of slots_of."""
    half, keys = _network(size, key)
    swap = lambda x: (x & np.uint64((1 << half) - 1)) << np.uint64(half) | x >> np.uint64(half)
    return _walk(slot, size, lambda x: swap(feistel(swap(x), half, keys[::-1])))


def packed(docs: DataFrame, vocabulary: str, pattern: str, key: str, text: str, length: int) -> DataFrame:
    """part, place, ids (length - 1 numbers of two bytes), n_tokens without padding, doc_ids in their order."""
    room = length - 1

    def work(batches):
        own, part, place = encoder(vocabulary, pattern), TaskContext.get().partitionId(), 0
        ids: list[int] = []
        owners: list[tuple[int, int | None]] = []  # where in `ids` a document begins

        def cut(last: bool):
            nonlocal ids, owners, place
            rows, at = [], 0
            while len(ids) - at >= room or (last and at < len(ids)):
                piece = ids[at : at + room]
                first = max((i for i, (begin, _) in enumerate(owners) if begin <= at), default=0)
                inside = [k for begin, k in owners[first:] if begin < at + len(piece)]
                owners = owners[first:]
                full = np.array(piece + [own.end] * (room - len(piece)), "<u2").tobytes()
                rows.append((part, place, full, len(piece), inside))
                at, place = at + room, place + 1
            ids, owners = ids[at:], [(begin - at, k) for begin, k in owners if begin < len(ids)]
            parts, places, values, counts, keys = zip(*rows) if rows else ((),) * 5
            return record_batch([
                ("part", pa.int64(), parts), ("place", pa.int64(), places), ("ids", pa.binary(), values),
                ("n_tokens", pa.int64(), counts), ("doc_ids", pa.list_(pa.int64()), keys),
            ])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                owners.append((len(ids), k))
                ids += own.encode(t or "")
                ids.append(own.end)
                if len(ids) >= 256 * room:
                    yield cut(False)
        yield cut(True)

    rows = docs.select(F.col(key).cast("long"), F.col(text))
    return rows.mapInArrow(work, "part long, place long, ids binary, n_tokens long, doc_ids array<long>")


def write(
    docs: DataFrame, path: str, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
    length: int = SEQUENCE, shard_sequences: int = SHARD_SEQUENCES, seed: int = KEY,
) -> DataFrame:
    """Write the shards of `docs` below `path` and return a row for each sequence.

    slot, shard, byte_offset in the shard's file, n_tokens (without padding),
    doc_ids that begin in it or reach into it, and ids_crc32 of its ids. A null
    text counts as empty and is an end id alone; null keys and repeated rows stay;
    an empty table writes nothing. The files of a shard's folder, one each, hold
    records of 2 * length bytes. The last sequence of each task is padded with end ids.
    """
    spark = shipped(docs).sparkSession
    store = scratch.new_dir(spark, "sequences")
    # The encoded sequences are stored once: their numbers and what is written come from the same rows.
    packed(docs, vocabulary, pattern, key, text, length).write.option("compression", "zstd").parquet(store)
    rows = spark.read.schema("part long, place long, ids binary, n_tokens long, doc_ids array<long>").parquet(store)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each task that encoded.
    parts = rows.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    size = rows.count()

    def place(batches):
        pack = zstandard.ZstdCompressor(level=9)
        for batch in batches:
            slot = slots_of(batch.column(0).to_numpy(), size, seed)
            ids = batch.column(1).to_pylist()
            yield record_batch([
                ("slot", pa.int64(), slot), ("shard", pa.int64(), slot // shard_sequences),
                ("packed", pa.binary(), [pack.compress(i) for i in ids]),
            ])

    def unpack(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            yield record_batch([
                ("shard", pa.int64(), batch.column(0)),
                ("value", pa.binary(), [open_.decompress(v) for v in batch.column(1).to_pylist()]),
            ])

    numbered = rows.join(F.broadcast(parts), "part").withColumn("number", F.col("before") + F.col("place"))
    placed = numbered.select("number", "ids").mapInArrow(place, "slot long, shard long, packed binary")
    shards = max(1, -(-size // shard_sequences))
    records = (
        placed.repartition(min(shards, 4 * partitions(spark)), "shard").sortWithinPartitions("shard", "slot")
        .select("shard", "packed").mapInArrow(unpack, "shard long, value binary")
    )
    closing = encoder(vocabulary, pattern).end.to_bytes(2, "little").decode("latin-1")
    (
        records.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard")
        .option("encoding", "ISO-8859-1").option("lineSep", closing).option("compression", "none").text(path)
    )

    def listed(batches):
        for batch in batches:
            slot = slots_of(batch.column(0).to_numpy(), size, seed)
            yield record_batch([
                ("slot", pa.int64(), slot), ("shard", pa.int64(), slot // shard_sequences),
                ("byte_offset", pa.int64(), slot % shard_sequences * 2 * length),
                ("n_tokens", pa.int64(), batch.column(2)), ("doc_ids", pa.list_(pa.int64()), batch.column(3)),
                ("ids_crc32", pa.int64(), [zlib.crc32(i) for i in batch.column(1).to_pylist()]),
            ])

    schema = "slot long, shard long, byte_offset long, n_tokens long, doc_ids array<long>, ids_crc32 long"
    return numbered.select("number", "ids", "n_tokens", "doc_ids").mapInArrow(listed, schema)
