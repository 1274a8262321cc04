"""Merkle manifest of a data set: trees of sixteens in blocks with a van Emde Boas layout.

A block is an aligned subtree of `HEIGHT` levels above its leaves, kept as one
string of digests. Inside it the levels are split at half height, again and
again: first the upper part, then each lower part from left to right. Places
are worked out by arithmetic alone, without pointers, and a ragged right edge
takes no room. Block roots are the leaves of the next tier of blocks, and the
roots of all trees are the leaves of one last tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.llm.common import written
from payloom.llm.ranking import ranked

FANOUT = 16
HEIGHT = 3
LEAVES = FANOUT ** HEIGHT
BYTES = 32


def node_count(levels: int, leaves):
    """Nodes of a tree of so many levels over so many leaves."""
    return sum(-(-leaves // FANOUT ** k) for k in range(levels))


def address(levels: int, leaves, level: int, index):
    """Place of a node in the layout; level 0 are the leaves, the root is at 0.

    leaves and index may be arrays. The lower parts have half of the levels,
    each below its own node of the upper part's lowest level.
    """
    if levels == 1:
        return 0 * index
    lower = levels // 2
    span = FANOUT ** (lower - 1)
    top = -(-leaves // (span * FANOUT))
    if level >= lower:
        return address(levels - lower, top, level - lower, index)
    each = FANOUT ** (lower - 1 - level)
    part = index // each
    own = np.minimum(span, leaves - part * span)
    return node_count(levels - lower, top) + part * node_count(lower, span) + address(lower, own, level, index % each)


@lru_cache(maxsize=64)
def layout(levels: int, leaves: int) -> list[np.ndarray]:
    """Addresses of all nodes of a block, level by level."""
    return [address(levels, leaves, k, np.arange(-(-leaves // FANOUT ** k), dtype=np.int64)) for k in range(levels)]


def digest_of(children: bytes) -> bytes:
    """Digest of nodes that follow each other: of their hexadecimal texts."""
    return hashlib.sha256(children.hex().encode()).digest()


def levels_of(leaves: int, block: int) -> int:
    """Levels of a block. Only a tree's sole block can be the first one and short: it ends where one node is left."""
    if block or leaves == LEAVES:
        return HEIGHT + 1
    levels = 1
    while FANOUT ** (levels - 1) < leaves:
        levels += 1
    return levels


def build_block(leaves: list[bytes], block: int) -> bytes:
    """All digests of a block in their layout."""
    levels = levels_of(len(leaves), block)
    nodes = np.zeros((node_count(levels, len(leaves)), BYTES), np.uint8)
    row = leaves
    for places in layout(levels, len(leaves)):
        nodes[places] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, BYTES)
        row = [digest_of(b"".join(row[k:k + FANOUT])) for k in range(0, len(row), FANOUT)]
    return nodes.tobytes()


class Run(NamedTuple):
    """Siblings of a node: its place among them, and the texts of those before and after it."""

    before: bytes
    after: bytes


def packed(path: list[Run]) -> bytes:
    """A path as one string: for each level two numbers of siblings, then their digests."""
    return b"".join(bytes([len(r.before) // 64, len(r.after) // 64]) + bytes.fromhex((r.before + r.after).decode()) for r in path)


def unpacked(path: bytes) -> list[Run]:
    runs, at = [], 0
    while at < len(path):
        before, after = path[at], path[at + 1]
        text = path[at + 2:at + 2 + BYTES * (before + after)].hex().encode()
        runs.append(Run(text[:64 * before], text[64 * before:]))
        at += 2 + BYTES * (before + after)
    return runs


def fold(digest: bytes, path: list[Run]) -> bytes:
    """The root above a node, from its own digest and its siblings."""
    for run in path:
        digest = hashlib.sha256(run.before + digest.hex().encode() + run.after).digest()
    return digest


class Block:
    """A block's digests, looked up by level and index."""

    def __init__(self, nodes: bytes, leaves: int, block: int):
        self.nodes, self.leaves, self.levels = nodes, leaves, levels_of(leaves, block)
        self.places = layout(self.levels, leaves)

    def node(self, level: int, index: int) -> bytes:
        at = BYTES * int(self.places[level][index])
        return self.nodes[at:at + BYTES]

    def siblings(self, level: int, index: int) -> list[Run]:
        """For each node of the run that the index lies in, its siblings. A run lies together in the layout or is the root."""
        first = index - index % FANOUT
        last = min(first + FANOUT, len(self.places[level]))
        text = b"".join(self.node(level, k) for k in range(first, last)).hex().encode()
        return [Run(text[:64 * k], text[64 * (k + 1):]) for k in range(last - first)]

    def paths(self) -> Iterator[tuple[int, Run | None, tuple[Run, ...]]]:
        """For each leaf its index, its siblings, and those of the nodes above it up to the block's root."""
        def above(level: int, index: int) -> tuple[Run, ...]:
            if level >= self.levels - 1:
                return ()
            key = level, index
            if key not in known:
                known[key] = (self.siblings(level, index)[index % FANOUT], *above(level + 1, index // FANOUT))
            return known[key]

        known: dict[tuple[int, int], tuple[Run, ...]] = {}
        if self.levels == 1:
            yield 0, None, ()
            return
        for first in range(0, self.leaves, FANOUT):
            upper = above(1, first // FANOUT)
            for k, run in enumerate(self.siblings(0, first)):
                yield first + k, run, upper


class Manifest(NamedTuple):
    """Tiers of blocks of all trees, those of the tree over their roots, the root's digest and the carried columns."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    root: bytes
    carried: list[T.StructField]


def _blocks(nodes: DataFrame, carried: list[T.StructField], name: str) -> DataFrame:
    """Blocks (tree, block, n, nodes, carried arrays) of nodes (tree, pos, digest, carried columns).

    A block's rows meet in one task, so a tree with a third of all leaves is
    spread over as many tasks as it has blocks.
    """
    tree = nodes.schema["tree"]
    schema = T.StructType([tree, T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("nodes", T.BinaryType()),
                           *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in carried)])
    names = [f.name for f in carried]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "digest", *names)), strict=True)

        def finished() -> tuple:
            return (*now, len(leaves), build_block(leaves, now[1]), *kept)

        now, leaves, done = None, [], []
        kept: list[list] = [[] for _ in names]
        types = None
        for tree_key, block, digest, *values in rows():
            if now != (tree_key, block):
                if now:
                    done.append(finished())
                    if len(done) == 16:
                        yield _batch(done, schema)
                        done = []
                now, leaves, kept = (tree_key, block), [], [[] for _ in names]
            leaves.append(digest)
            for column, value in zip(kept, values, strict=True):
                column.append(value)
        if now:
            yield _batch([*done, finished()], schema)

    placed = nodes.withColumn("block", F.floor(F.col("pos") / LEAVES).cast("long"))
    arranged = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").select("tree", "block", "digest", *names)
    return written(arranged.mapInArrow(build, schema), name)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    arrays = [pa.array(values, to_arrow_type(f.dataType)) for values, f in zip(zip(*rows, strict=True), schema.fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _root_of(blocks: DataFrame) -> DataFrame:
    return blocks.select("tree", F.col("block").alias("pos"), F.substring("nodes", 1, BYTES).alias("digest"), ((F.col("block") == 0) & (F.col("n") < LEAVES)).alias("sole"))


def _tiers(nodes: DataFrame, carried: list[T.StructField], name: str) -> list[DataFrame]:
    """Blocks of the nodes, then of the roots of blocks, until every tree has a sole block."""
    tiers = [_blocks(nodes, carried, f"{name}-0")]
    while not (more := _root_of(tiers[-1]).filter("NOT sole").drop("sole")).isEmpty():
        tiers.append(_blocks(more, [], f"{name}-{len(tiers)}"))
    return tiers


def merkle_manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of leaves (tree, digest, further columns), in the given order within each tree, nulls first.

    Every further column is carried in the blocks of the lowest tier. Rows that
    share tree and order lie by digest. Trees follow each other by their name,
    null first, bytewise. An empty table has the digest of nothing as its root.
    One digest reaches the driver, and of each step one row per partition.
    """
    carried = [f for f in leaves.schema.fields if f.name not in ("tree", "digest")]
    rest = [f.name for f in carried if f.name not in order]
    placed = ranked(written(leaves, "merkle-leaves"), "tree", [*order, "digest", *rest], "merkle-ranked")
    tiers = _tiers(placed, carried, "merkle-tier")
    roots = [_root_of(blocks).filter("sole").select(F.lit(0).alias("all"), F.col("tree").alias("name"), "digest", F.lit(t).alias("tier"))
             for t, blocks in enumerate(tiers)]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    ordered = ranked(subroots, "all", ["name"], "merkle-subroots").withColumnRenamed("all", "tree")
    top = _tiers(ordered, [f for f in subroots.schema.fields if f.name in ("name", "tier")], "merkle-top")
    row = _root_of(top[-1]).filter("sole").first()
    return Manifest(tiers, top, bytes(row["digest"]) if row else digest_of(b""), carried)


ABOVE = [T.StructField("block", T.LongType()), T.StructField("above", T.BinaryType()), T.StructField("subroot", T.BinaryType())]


def _paths_below(blocks: DataFrame) -> DataFrame:
    """For each leaf of blocks (with the path above them) the block below it, its path and the root of its tree."""
    schema = T.StructType([blocks.schema["tree"], *ABOVE])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, nodes, above, subroot in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "n", "nodes", "above", "subroot")), strict=True):
                out = [(tree, LEAVES * block + k, packed([run, *upper]) + above if run else above, subroot) for k, run, upper in Block(nodes, n, block).paths()]
                yield _batch(out, schema)

    return blocks.select("tree", "block", "n", "nodes", "above", "subroot").mapInArrow(descend, schema)


def _named_paths(blocks: DataFrame) -> DataFrame:
    """For each tree's root the path to the manifest's root: (name, tier, above)."""
    schema = T.StructType([T.StructField("name", blocks.schema["name"].dataType.elementType), T.StructField("tier", T.IntegerType()), T.StructField("above", T.BinaryType())])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, nodes, above, names, tiers in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "nodes", "above", "name", "tier")), strict=True):
                out = [(names[k], tiers[k], packed([run, *upper]) + above if run else above) for k, run, upper in Block(nodes, n, block).paths()]
                yield _batch(out, schema)

    return blocks.select("block", "n", "nodes", "above", "name", "tier").mapInArrow(descend, schema)


def _with_paths(tiers: list[DataFrame], start) -> DataFrame:
    """The lowest tier's blocks with the paths above them; `start` gives those of the sole blocks of a tier."""
    paths = None
    for t in reversed(range(len(tiers))):
        blocks = tiers[t]
        sole = start(t, blocks.filter(f"block = 0 AND n < {LEAVES}"))
        if paths is not None:
            p = paths.select(F.col("tree").alias("p_tree"), F.col("block").alias("p_block"), "above", "subroot")
            inner = blocks.filter(f"NOT (block = 0 AND n < {LEAVES})").join(p, F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("block") == F.col("p_block"))).drop("p_tree", "p_block")
            sole = sole.unionByName(inner)
        if t == 0:
            return sole
        paths = written(_paths_below(sole), "merkle-paths")
    raise AssertionError("a manifest has a tier")


AUDIT = [T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [T.StructField("verified", T.BooleanType())]


def audit(manifest: Manifest, claimed: str | None = None, proofs: bool = False) -> DataFrame:
    """Every leaf with its proof checked: carried columns, leaf, subroot, root, proof_sha256, folded_root, verified.

    claimed: a carried column with another digest to fold in place of a leaf's
    own where it isn't null. proofs: also the siblings themselves, as ``path``
    (`unpacked` reads it), nearest level first.
    """
    top = _with_paths(manifest.top, lambda t, sole: sole.withColumns({"above": F.lit(b""), "subroot": F.substring("nodes", 1, BYTES)}))
    named = written(_named_paths(top), "merkle-named")

    def start(t: int, sole: DataFrame) -> DataFrame:
        here = named.filter(F.col("tier") == t).select("name", "above")
        return sole.join(here, F.col("tree").eqNullSafe(F.col("name"))).drop("name").withColumn("subroot", F.substring("nodes", 1, BYTES))

    blocks = _with_paths(manifest.tiers, start)
    fields = manifest.carried
    schema = T.StructType([blocks.schema["tree"], *fields, *AUDIT, *([T.StructField("path", T.BinaryType())] if proofs else [])])
    names, root = [f.name for f in fields], manifest.root
    other = names.index(claimed) if claimed else None

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, nodes, above, subroot, *kept in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "n", "nodes", "above", "subroot", *names)), strict=True):
                here, over, out = Block(nodes, n, block), unpacked(above), []
                over_text = b"".join(r.before + r.after for r in over)
                folded: dict[bytes, bytes] = {}
                shared, text = None, b""
                for k, run, upper in here.paths():
                    if upper is not shared:
                        shared, text = upper, b"".join(r.before + r.after for r in upper) + over_text
                    leaf = here.node(0, k)
                    digest = leaf if other is None or kept[other][k] is None else kept[other][k]
                    first = fold(digest, [run] if run else [])
                    if first not in folded:
                        folded[first] = fold(fold(first, list(upper)), over)
                    siblings = run.before + run.after if run else b""
                    row = (tree, *(column[k] for column in kept), leaf.hex(), subroot.hex(), root.hex(), hashlib.sha256(siblings + (text if run else over_text)).hexdigest(),
                           folded[first].hex(), folded[first] == root)
                    out.append((*row, packed([*([run] if run else []), *upper]) + above) if proofs else row)
                    if len(out) == LEAVES // 4:
                        yield _batch(out, schema)
                        out = []
                if out:
                    yield _batch(out, schema)

    return blocks.select("tree", "block", "n", "nodes", "above", "subroot", *names).mapInArrow(check, schema)


def record_digest(*values: Column) -> Column:
    """SHA-256 of values written one after the other: ``-`` for null, else their length in bytes, a colon and their text."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))
