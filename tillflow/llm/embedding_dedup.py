"""Near-duplicate vectors by p-stable hashing and exact cosines.

Vectors are scaled to length one, where a cosine is a Euclidean distance. Each
table hashes a vector to the cells, `WIDTH` wide and randomly shifted, that its
projections on Gaussian directions fall into. Only vectors that share a bucket
are compared, by their exact cosine in double precision. The number of directions
grows with the logarithm of the number of vectors, so that chance meetings stay
few, and the number of tables so that a link is missed with at most `MISS`.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import arrow_map, partitions, record_batch, shipped, stored
from tillflow.llm.components import components

COSINE = 0.95
WIDTH = 1.2
MISS = 0.001
SEED = 977
# Members of a bucket that are compared as one block, and rows that a task's group holds.
BLOCK = 256
GROUP_ROWS = 20_000


def meets(distance: float, width: float) -> float:
    """The chance that two vectors at `distance` share the cell of one Gaussian direction."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def shape(vectors: int, cosine: float = COSINE, width: float = WIDTH, miss: float = MISS) -> tuple[int, int]:
    """Directions in a table, and tables, for so many vectors."""
    near, far = meets(math.sqrt(2 - 2 * cosine), width), meets(math.sqrt(2), width)
    directions = max(4, math.ceil(math.log(max(vectors, 2)) / -math.log(far)))
    return directions, math.ceil(math.log(miss) / math.log1p(-(near**directions)))


@lru_cache(maxsize=4)
def axes_of(dim: int, directions: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The Gaussian axes, shifts and bucket factors; drawn once in a worker, the same in all."""
    random = np.random.Generator(np.random.PCG64([SEED, dim, directions, tables]))
    axes = random.standard_normal((dim, directions * tables))
    shift = random.uniform(0, WIDTH, directions * tables)
    return axes, shift, random.integers(1, 2**63, (tables, directions), dtype=np.int64) | 1


def buckets_of(unit: np.ndarray, directions: int, tables: int) -> np.ndarray:
    """A 64-bit bucket for each vector and table; the same wherever it is worked out."""
    axes, shift, factors = axes_of(unit.shape[1], directions, tables)
    cells = np.floor((unit @ axes + shift) / WIDTH).astype(np.int64).reshape(len(unit), tables, directions)
    return (cells * factors).sum(2) + (np.arange(tables) + tables * unit.shape[1]) * np.int64(0x9E3779B97F4A7C1)


def _units(batch_column) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in batch_column])
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def vector_classes(rows: DataFrame) -> DataFrame:
    """h1, h2, cls (its number), vector, dim, members and smallest key of equal vectors that can link; folded map-side."""
    usable = (
        F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    return (
        rows.filter(F.coalesce(usable, F.lit(False))).groupBy("h1", "h2")
        .agg(F.any_value("vector").alias("vector"), F.count("*").alias("members"), F.min("key").alias("smallest"))
        .withColumns({"dim": F.size("vector"), "cls": F.xxhash64("h1", "h2")})
    )


def _compared(directions: int, tables: int, cosine: float):
    """Counts and a spanning forest of the links inside each block pair of a group."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (table, first, second, _, _), block in frame.groupby(["table", "first", "second", "bucket", "dim"], sort=False):
            if len(block) < 2:
                continue
            unit = _units(block["vector"])
            part, ids, members = block["part"].to_numpy(), block["cls"].to_numpy(), block["members"].to_numpy()
            x, y = np.nonzero(np.triu(unit @ unit.T >= cosine, 1))
            if first != second:
                keep = part[x] != part[y]
                x, y = x[keep], y[keep]
            if not len(x):
                continue
            # A pair counts in the first table it shares: only linked vectors need their buckets.
            near, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            codes = buckets_of(unit[near], directions, tables)
            keep = (codes[at[: len(x)]] == codes[at[len(x) :]]).argmax(1) == table
            x, y = x[keep], y[keep]
            links = np.bincount(x, members[y], len(ids)) + np.bincount(y, members[x], len(ids))
            out += [(int(ids[i]), None, int(links[i])) for i in np.nonzero(links)[0]]
            root = list(range(len(ids)))
            for a, b in zip(x.tolist(), y.tolist()):
                while root[a] != a:
                    root[a] = a = root[root[a]]
                while root[b] != b:
                    root[b] = b = root[root[b]]
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((int(ids[a]), int(ids[b]), 0))
        # Each column by its own type: among nulls, numbers of 64 bits would turn into floats.
        a, b, n = zip(*out) if out else ((), (), ())
        return pd.DataFrame({"a": pd.array(a, "int64"), "b": pd.array(b, "Int64"), "n": pd.array(n, "int64")})

    return compare


def near_links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Rows (a, b, n): n > 0 vectors linked with class a in one block, or a link from a to b (n = 0)."""
    spark = classes.sparkSession
    directions, tables = shape(classes.count(), cosine)

    def hashed(batch):
        vectors, keys, dims = batch.column(1).to_pylist(), batch.column(0).to_numpy(), batch.column(2).to_numpy()
        ids, buckets = [keys[:0]], [np.zeros(0, np.int64)]
        for dim in np.unique(dims):
            at = np.nonzero(dims == dim)[0]
            found = buckets_of(_units([vectors[i] for i in at]), directions, tables)
            ids.append(np.repeat(keys[at], tables))
            buckets.append(found.ravel())
        return record_batch([
            ("cls", pa.int64(), np.concatenate(ids)), ("bucket", pa.int64(), np.concatenate(buckets)),
            ("table", pa.int32(), np.tile(np.arange(tables), sum(map(len, ids)) // max(tables, 1))),
        ])

    entries = stored(arrow_map(classes.select("cls", "vector", "dim"), hashed, "cls long, bucket long, table int"), "vector-buckets")
    shared = entries.groupBy("bucket", "table").agg(F.count("*").alias("size")).filter("size > 1")
    members = entries.join(shared, ["bucket", "table"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    paired = (
        members.withColumn("part", F.pmod(F.xxhash64("cls"), blocks).cast("int")).withColumn("other", other)
        .withColumns({"first": F.least("part", "other"), "second": F.greatest("part", "other")})
        .select("cls", "bucket", "table", "part", "first", "second")
    )
    paired = stored(paired, "vector-pairs")
    groups = max(partitions(spark), paired.count() // GROUP_ROWS)
    full = paired.join(classes.select("cls", "vector", "members", "dim"), "cls").withColumn(
        "g", F.pmod(F.xxhash64("bucket", "table", "first", "second"), F.lit(groups))
    )
    return shipped(full).groupBy("g").applyInPandas(_compared(directions, tables, cosine), "a long, b long, n long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """key, n_links, component_id and kept of every row of `vectors`.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing, and so do vectors of different length. Equal vectors link with each
    other and are hashed once. A row whose key is null takes part, but names no
    component. Repeated rows are rows of their own; an empty table gives an empty
    result; further columns are not read.
    """
    slim = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    slim = slim.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(SEED), "vector", F.size("vector"))})
    classes = stored(vector_classes(slim), "vector-classes")
    found = stored(near_links(classes, cosine), "vector-links")
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    known = stored(
        classes.select("h1", "h2", "members", "cls", "smallest")
        .join(counts, F.col("cls") == F.col("a"), "left").join(roots, F.col("cls") == F.col("node"), "left")
        .select(
            "h1", "h2", "smallest", F.coalesce("component", "cls").alias("component"),
            (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
        ),
        "vector-roots",
    )
    named = known.groupBy("component").agg(F.min("smallest").alias("root"))
    known = known.join(named, "component").select("h1", "h2", "n", "root")
    return slim.select("key", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "key", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "key").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
