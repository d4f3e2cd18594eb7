"""Merkle manifest of a dataset, as a persistent tree with one version for each changed row.

Rows are leaves; those of one group (a language) form a tree of their own, and the
groups' roots form the tree on top. A tree is built in tiers: aligned blocks of
`FANOUT ** BLOCK_LEVELS` nodes become subtrees, one block at a time wherever it
lies, and the blocks' roots are the nodes of the next tier. On the way back each
block is handed the path from its root to the top, one row. With that, a block's
task proves its leaves and makes the versions: a changed leaf copies its
ancestors inside the block, then those above it, and shares every other node with
the original tree. No task holds more than a block, and no version more than a path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import LOWER, UPPER, partitions, placed, shipped, stored, with_offsets

# Nodes of a run, and what a row's leaf is made of.
FANOUT, FANOUT_BITS = 8, 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels that one task builds: blocks of 4,096 nodes.
BLOCK_LEVELS = 4
DIGITS = 64

PATH = "array<struct<at: int, siblings: string>>"
PATHS = f"tree string, pos long, path {PATH}"
NODE = "tree string, pos long, digest binary, height int"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class BlockTree:
    """The nodes of one aligned block: `levels[0]` as given, each further level the runs' digests.

    The base version is never changed; `copy` gives the nodes in which another
    version differs from it.
    """

    def __init__(self, nodes: list[str], height: int):
        self.runs: list[list[str]] = []  # for each level but the last, the joined digests of every run
        while len(self.runs) < height:
            self.runs.append(["".join(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)])
            nodes = [digest(run) for run in self.runs[-1]]
        self.root = nodes[0]

    def path(self, place: int) -> list[tuple[int, str]]:
        """For each level: the node's number in its run, and the other nodes of the run, joined."""
        found = []
        for runs in self.runs:
            place, at = divmod(place, FANOUT)
            run = runs[place]
            found.append((at, run[: at * DIGITS] + run[(at + 1) * DIGITS :]))
        return found


def copied(node: str, path: list[tuple[int, str]]) -> list[str]:
    """The ancestors of a version in which the node at the foot of `path` is `node`, lowest first."""
    found = []
    for at, siblings in path:
        node = digest(siblings[: at * DIGITS] + node + siblings[at * DIGITS :])
        found.append(node)
    return found


def _sorted(block: pa.Table) -> pa.Table:
    return block.sort_by("pos")


def _block_tree(block: pa.Table, levels: int) -> BlockTree:
    height = min(block["height"][0].as_py(), levels)
    return BlockTree([d.hex() for d in block["digest"].to_pylist()], height)


def _above(paths: pa.Table) -> list[tuple[int, str]]:
    return [(step["at"], step["siblings"]) for step in paths["path"][0].as_py()]


def _top(key, block: pa.Table, levels: int) -> pa.Table:
    tree = _block_tree(_sorted(block), levels)
    name, number = (k.as_py() for k in key)
    left = max(0, block["height"][0].as_py() - levels)
    return pa.table({
        "tree": pa.array([name]), "pos": pa.array([number]),
        "digest": pa.array([bytes.fromhex(tree.root)]), "height": pa.array([left], pa.int32()),
    })


def _paths(block: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    block = _sorted(block)
    tree, rest = _block_tree(block, levels), _above(above)
    steps = [
        [{"at": at, "siblings": siblings} for at, siblings in [*tree.path(i), *rest]] for i in range(block.num_rows)
    ]
    kind = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))
    return pa.table({"tree": block["tree"], "pos": block["pos"], "path": pa.array(steps, kind)})


def _proofs(block: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    block = _sorted(block)
    tree, rest = _block_tree(block, levels), _above(above)
    upper = "".join(siblings for _, siblings in rest)
    leaves, changed = block["digest"].to_pylist(), block["changed"].to_pylist()
    proofs, folded, copies = [], [], []
    for i, (leaf, other) in enumerate(zip(leaves, changed)):
        path = tree.path(i)
        proofs.append(digest("".join(siblings for _, siblings in path) + upper))
        node = (leaf if other is None else other).hex()
        nodes = copied(node, [*path, *rest])
        folded.append(nodes[-1] if nodes else node)
        copies.append(None if other is None else nodes)
    # The base version's own top, from any leaf of the block.
    top = copied(leaves[0].hex(), [*tree.path(0), *rest])
    height = len(tree.runs) + len(rest)
    base = [top[-1] if height else leaves[0].hex()] * len(leaves)
    return pa.table({
        "tree": block["tree"], "pos": block["pos"], "key": block["key"], "leaf": pa.array([d.hex() for d in leaves]),
        "root": pa.array(base), "proof": pa.array(proofs), "folded": pa.array(folded),
        "copies": pa.array(copies, pa.list_(pa.string())),
    })


def field(column: Column) -> Column:
    """A value as it goes into a leaf: `-` if null, else its length in UTF-8 bytes, a colon, and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def numbered(leaves: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """`leaves` with each row's place `pos` in its `tree`, and the tree's `height`.

    Rows that tie in `order` tie in all that they hold; a row's place in the scan
    tells them apart, so that a huge group of equal rows is still split.
    """
    spark = leaves.sparkSession
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())
    rows = placed(tied, partitions(spark), [F.col(c) for c in [*order, "_tie"]], purpose).drop("_tie")
    parts = stored(with_offsets(rows, "tree", F.count("*")), f"{purpose}-offsets")
    levels = sum((F.lit(FANOUT**h) < F.sum("_sum")).cast("int") for h in range(21))
    heights = parts.groupBy("tree").agg(levels.alias("height"))
    known = parts.select("tree", "_part", (F.col("_before") - F.col("_first")).alias("_shift")).join(heights, "tree")
    return rows.join(known, ["tree", "_part"]).withColumn("pos", F.col("_shift") + F.col("_place")).drop(
        "_part", "_place", "_shift"
    )


def by_block(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.shiftright("pos", FANOUT_BITS * levels)).groupBy("tree", "block")


def climb(leaves: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above `leaves` (tree, pos, digest, height), and the root of each tree (tree, digest, tier)."""
    def top(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        return _top(key, block, levels)

    tiers, roots = [leaves.select("tree", "pos", "digest", "height")], []
    while True:
        tops = stored(by_block(shipped(tiers[-1]), levels).applyInArrow(top, NODE), "manifest-tops")
        roots.append(tops.filter("height = 0").select("tree", "digest", F.lit(len(tiers) - 1).alias("tier")))
        rest = tops.filter("height > 0")
        if rest.isEmpty():
            break
        tiers.append(rest)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return tiers, found


def descend(tiers: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """The paths (tree, block, path) that the blocks of the lowest tier are handed.

    `ends` holds the path above each tree's root, and the tier in which the tree ends.
    """
    above = None
    for tier in range(len(tiers) - 1, -1, -1):
        here = ends.filter(F.col("tier") == tier).select("tree", F.lit(0).cast("long").alias("block"), "path")
        above = here if above is None else above.unionByName(here)
        if tier:
            paths = cogrouped(tiers[tier], above, _paths, PATHS, levels)
            above = stored(paths.withColumnRenamed("pos", "block"), "manifest-paths")
    return above


def cogrouped(nodes: DataFrame, above: DataFrame, work: Callable, schema: str, levels: int) -> DataFrame:
    def run(block: pa.Table, paths: pa.Table) -> pa.Table:
        return work(block, paths, levels)

    return by_block(nodes, levels).cogroup(above.groupBy("tree", "block")).applyInArrow(run, schema)


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    columns: tuple[str, ...] = COLUMNS,
    group: str = "lang",
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row for each row of `docs`: key, leaf, subroot, root, proof_sha256, folded_root, verified, copies.

    A leaf is the digest of the row's `columns`; leaves of one `group` ascend by `key`
    (nulls first), and the groups' roots by `group` (nulls first, then bytewise). Rows
    for which `where` holds make a version: their leaf is worked out anew with the
    `changed` columns, and `copies` lists the digests of the copied ancestors from its
    parent to the version's root; it is null for other rows. `folded_root` is the root
    that the changed leaf, or else the leaf, leads to beside its original siblings.

    Null values have a form of their own in a leaf and differ from empty ones. Rows
    whose key repeats are ordered by leaf; equal rows are leaves of their own. A
    condition that is null makes no version. An empty table gives an empty result;
    further columns are not read, whatever their names.
    """
    values = [F.col(c) for c in columns]
    leaf = leaf_of(values)
    other = F.lit(None).cast("binary")
    if where is not None:
        other = F.when(where, leaf_of([(changed or {}).get(c, F.col(c)) for c in columns]))
    slim = docs.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        leaf.alias("digest"), other.alias("changed"),
    )
    # Read twice, up and down: places must be the same both times, so they are stored.
    leaves = stored(numbered(slim, ["tree", "key", "digest"], "manifest-order"), "manifest-leaves")
    tiers, roots = climb(leaves, block_levels)
    subroots = stored(roots, "manifest-subroots")
    crown = stored(numbered(
        subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"], "manifest-crown-order"
    ), "manifest-crown")
    crown_tiers, top = climb(crown, block_levels)
    no_path = top.select("tree", "tier", F.expr(f"cast(array() as {PATH})").alias("path"))
    crown_paths = cogrouped(
        crown_tiers[0], descend(crown_tiers, no_path, block_levels), _paths, PATHS, block_levels
    ).select("pos", "path")
    ends = stored(
        crown.join(crown_paths, "pos").select(F.col("name").alias("tree"), "path").join(subroots.select("tree", "tier"), "tree"),
        "manifest-ends",
    )
    kind = docs.schema[key].dataType.simpleString()
    found = cogrouped(
        leaves, descend(tiers, ends, block_levels), _proofs,
        f"tree string, pos long, key {kind}, leaf string, root string, proof string, folded string, copies array<string>",
        block_levels,
    )
    return found.join(subroots.select("tree", F.lower(F.hex("digest")).alias("subroot")), "tree").select(
        "key", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"), "copies",
    )


def version_nodes(proofs: DataFrame) -> DataFrame:
    """The nodes that the versions in a manifest do not share: key, level (1: parents of leaves), digest."""
    return proofs.filter("copies IS NOT NULL").select(
        "key", F.posexplode("copies").alias("level", "digest")
    ).withColumn("level", F.col("level") + 1)


def tampered(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of documents of which a third have A to Z in their text lower-cased."""
    return manifest(
        docs, changed={"text": F.translate(F.col("text"), UPPER, LOWER)},
        where=F.crc32(F.col("doc_id").cast("string")) % 3 == 0, block_levels=block_levels,
    )
