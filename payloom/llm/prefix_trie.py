"""Prefix trie of conversations that are rebuilt from another one's head and their own suffix.

The fingerprint of a sequence of turns is a product in a monoid: pairs of a
polynomial value and a length, where two sequences are put together without
looking at their turns. Prefixes of stored conversations get theirs from one
running product; those of rebuilt conversations are combined from a base's
head and an own segment. No rebuilt text exists anywhere: rows refer to stored
turns by digest, and members of a prefix group are the same sequence because
their last turns are, level by level.

Each conversation owns the nodes of which it is the smallest member. These
are the lower end of its path, so the trie falls into one chain per
conversation, and sums over subtrees are sums over chains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import WORD, written
from payloom.llm.ranking import MODULUS, element, joined, ranked, split

#: Rows of one conversation that meet in a task.
CHUNK = 1 << 16
#: Parts into which the children of a node are dealt where they look it up.
SALTS = 1024
DIGEST = ["q0", "q1", "q2", "q3"]
NODE = ["depth", "hi", "lo"]


def bases() -> Iterator[int]:
    """Bases of the polynomial, one after the other should two sequences share a fingerprint."""
    for k in range(8):
        yield int.from_bytes(hashlib.sha256(f"turns {k}".encode()).digest()[:16], "big") % MODULUS


def turn_digests(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, words, q0..q3): turns by the SHA-256 of role and text, nulls as empty; rows without conversation are left out."""
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what).cast("binary"), 256)
    quarters = [F.conv(F.substring("digest", 1 + 16 * k, 16), 16, -10).cast("long").alias(c) for k, c in enumerate(DIGEST)]
    plain = turns.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.regexp_count(what, F.lit(WORD)).cast("long").alias("words"), digest.alias("digest"))
    return written(plain.select("conv_id", "turn", "words", *quarters), "trie-turns")


def rebuilt(turns: DataFrame, head: Column, source: Column, longest: int, base: int) -> DataFrame:
    """(conv_id, depth, hi, lo, q0..q3, words, ended): a row per prefix of each rebuilt conversation, the empty one included.

    A conversation's first turns come from the conversation `source`, as many
    as `head` says and that one has; then come its own turns after as many.
    Both are expressions of conv_id; `longest` is the largest head. Turns that share their
    number are in the order of their digests.
    """
    stored = ranked(turns, "conv_id", ["turn", *DIGEST, "words"], "trie-ranked", digest=("q0", "q1"), base=base)
    fields = ["hi", "lo", *DIGEST, "words"]
    first = stored.filter(F.col("pos") < longest).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("turns"))
    sizes = stored.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    empty = F.array().cast(first.schema["turns"].dataType)
    own = sizes.join(first, "conv_id").withColumns({"h": head.cast("int"), "source": source})
    base_heads = first.select(F.col("conv_id").alias("source"), F.col("turns").alias("base"))
    plan = own.join(base_heads, "source", "left").withColumn("base", F.slice(F.coalesce("base", empty), F.lit(1), F.col("h")))

    def last(of: Column, name: str, there: Column) -> Column:
        return F.coalesce(F.when(there, F.get(of, F.least(F.col("h"), F.size(of)) - 1).getField(name)), F.lit(0)).cast("long")

    beyond = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = written(plan.select(
        "conv_id", "n", "h", "base", F.size("base").alias("taken"), (F.size("base") + beyond).alias("length"),
        last(F.col("base"), "hi", F.size("base") > 0).alias("bhi"), last(F.col("base"), "lo", F.size("base") > 0).alias("blo"),
        last(F.col("turns"), "hi", F.col("h") > 0).alias("ohi"), last(F.col("turns"), "lo", F.col("h") > 0).alias("olo")), "trie-plan")

    nothing = [F.lit(0).cast("long").alias(c) for c in ("depth", *fields)]
    root = plan.select("conv_id", *nothing, (F.col("length") == 0).alias("ended"))
    heads = plan.select("conv_id", "length", F.posexplode("base").alias("at", "t")).select(
        "conv_id", (F.col("at") + 1).cast("long").alias("depth"), *[F.col("t")[c].alias(c) for c in fields], (F.col("at") + 1 == F.col("length")).alias("ended"))

    # A conversation with a third of all turns is joined in chunks.
    parts = plan.filter("n > h").select("conv_id", "h", "taken", "length", "bhi", "blo", "ohi", "olo", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK).cast("long"))).alias("chunk"))
    mine = stored.withColumn("chunk", F.floor(F.col("pos") / CHUNK).cast("long")).join(parts, ["conv_id", "chunk"]).filter("pos >= h")
    beyond_head = (F.col("pos") + 1 - F.col("h")).cast("long")
    mine = mine.select("conv_id", (F.col("taken") + beyond_head).cast("long").alias("depth"), *fields, (F.col("taken") + beyond_head == F.col("length")).alias("ended"),
                       beyond_head.alias("beyond"), "bhi", "blo", "ohi", "olo")
    schema = "conv_id long, depth long, " + ", ".join(f"{c} long" for c in fields) + ", ended boolean"

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The base's head, then the own segment: own prefix less what the own head adds to it."""
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            his, los = [], []
            for hi, lo, beyond, bhi, blo, ohi, olo in zip(*(columns[c].to_pylist() for c in ("hi", "lo", "beyond", "bhi", "blo", "ohi", "olo")), strict=True):
                if bhi != ohi or blo != olo:
                    hi, lo = split((joined(hi, lo) + (joined(bhi, blo) - joined(ohi, olo)) * pow(base, beyond, MODULUS)) % MODULUS)
                his.append(hi)
                los.append(lo)
            columns |= {"hi": pa.array(his, pa.int64()), "lo": pa.array(los, pa.int64())}
            names = ["conv_id", "depth", *fields, "ended"]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return written(root.unionByName(heads).unionByName(mine.mapInArrow(combine, schema)), "trie-rows")


def _nodes(rows: DataFrame, base: int) -> DataFrame:
    """A row per fingerprint and depth, with its parent's fingerprint and whether its members' last turns differ."""
    same = F.lit(True)
    for c in DIGEST:
        same &= F.min(c) == F.max(c)
    groups = rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
                                     F.min("q0").alias("q0"), F.min("q1").alias("q1"), (~same).alias("clash"))
    inverse = pow(base, -1, MODULUS)

    def parent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [split((joined(hi, lo) - element(q0, q1)) * inverse % MODULUS) if depth else (None, None)
                     for depth, hi, lo, q0, q1 in zip(*(batch.column(c).to_pylist() for c in ("depth", "hi", "lo", "q0", "q1")), strict=True)]
            kept = ["depth", "hi", "lo", "conv_id", "n_convs", "words", "clash"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array([p[k] for p in found], pa.int64()) for k in range(2))],
                                             names=[*kept, "phi", "plo"])

    schema = "depth long, hi long, lo long, conv_id long, n_convs long, words long, clash boolean, phi long, plo long"
    return written(groups.mapInArrow(parent, schema), "trie-nodes")


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256): digest of the ids, in their order, of the conversations that end at a node.

    Ids are range-partitioned by node and id. A node inside one task is done
    there; one at a task's edge leaves pieces of text, and a last task reads
    those of a node one after the other.
    """
    keys = [F.col(c) for c in (*NODE, "conv_id")]
    arranged = rows.filter("ended").select(*NODE, "conv_id").repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "depth long, hi long, lo long, first long, piece string, ends_sha256 string"
    names = [*NODE, "first", "piece", "ends_sha256"]
    types = [pa.int64()] * 4 + [pa.string()] * 2

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first_node, out = None, True, []
        state, held, first = None, [], 0

        def spill() -> None:
            nonlocal held
            out.append((*now, first, ",".join(map(str, held)), None))
            held = []

        # The first node of a task may have begun before it, the last one may go on: both leave pieces.
        # Any other is first held as pieces too, and replaced by its digest once the next node begins.
        done: list[tuple] = []
        for batch in batches:
            for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
                if node != now:
                    if now is not None:
                        if first_node:
                            spill()
                            done += out
                        else:
                            state.update(",".join(map(str, held)).encode())
                            done.append((*now, None, None, state.hexdigest()))
                        out, first_node = [], False
                    now, state, held, first = node, hashlib.sha256(), [], conv
                    if len(done) >= 4096:
                        yield batch_of(done)
                        done = []
                if len(held) == 4096:
                    state.update((",".join(map(str, held)) + ",").encode())
                    spill()
                    first = conv
                    if first_node and len(out) >= 64:
                        yield batch_of(out)
                        out = []
                held.append(conv)
        if now is not None:
            spill()
            done += out
        if done:
            yield batch_of(done)

    parts = written(arranged.mapInArrow(pieces, schema), "trie-ends")
    finished = parts.filter("piece IS NULL").select(*NODE, "ends_sha256")
    edge = parts.filter("piece IS NOT NULL").repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for *node, piece in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece")), strict=True):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256()
                state.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([*types[:3], pa.string()])], names=[*NODE, "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, state.hexdigest()), [*types[:3], pa.string()], strict=True)], names=[*NODE, "ends_sha256"])

    return finished.unionByName(edge.mapInArrow(digest, "depth long, hi long, lo long, ends_sha256 string"))


def _chunk() -> Column:
    return F.floor(F.col("depth") / CHUNK).cast("long")


def prefix_trie(conversations: DataFrame, head: Column, source: Column, longest: int, **columns: str) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: depth, hi, lo (its fingerprint), conv_id (its smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `head`, `source` and `longest` are those of `rebuilt`, as expressions of conv_id. saved_tokens sums over the
    subtree what sharing saves: for each node the words of its last turn for every member but one.
    Rows without conversation id are left out; null roles and texts are empty ones; repeated turns are turns of their own;
    an empty table has no nodes. Further columns are ignored. All tables grow with the number of turns, at any depth.
    """
    turns = turn_digests(conversations, **columns)
    for base in bases():
        rows = rebuilt(turns, head, source, longest, base)
        nodes = _nodes(rows, base)
        if nodes.filter("clash").isEmpty():
            break
    else:
        raise RuntimeError("fingerprints of different prefixes clash under every base")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(children, NODE, "left").select(
        *NODE, "phi", "plo", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("value"), F.col("n_children").isNull().cast("long").alias("tip"), _chunk().alias("chunk"))
    tree = written(tree, "trie-tree")

    # What the chains of a node's other members hold, below it or beside their way there.
    chains = tree.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("value").alias("value"), F.sum("tip").alias("tip"))
    parts = chains.filter("top > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / CHUNK).cast("long"))))
    passing = rows.select("conv_id", *NODE, _chunk().alias("chunk")).join(parts, ["conv_id", "chunk"]).filter("depth < top")
    others = passing.groupBy(*NODE).agg(F.sum("value").alias("other_value"), F.sum("tip").alias("other_tips"))

    # The own chain from a node on: the rest of its chunk and all later chunks.
    below = Window.partitionBy("conv_id", "chunk").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv_id").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = tree.groupBy("conv_id", "chunk").agg(F.sum("value").alias("value"), F.sum("tip").alias("tip"), F.min("depth").alias("top"))
    chunks = chunks.select("conv_id", "chunk", F.coalesce(F.sum("value").over(later), F.lit(0)).alias("later_value"),
                           F.coalesce(F.sum("tip").over(later), F.lit(0)).alias("later_tips"), F.min("top").over(Window.partitionBy("conv_id")).alias("top"))
    own = tree.withColumns({"own_value": F.sum("value").over(below), "own_tips": F.sum("tip").over(below)}).join(chunks, ["conv_id", "chunk"])

    # Parents: a chain's own next node upwards, and for its top the owner of another chain, looked up by parts of the children.
    tops = own.filter("depth = top AND depth > 0").select(*NODE, (F.col("depth") - 1).alias("up"), "phi", "plo", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).alias("salt"))
    wanted = tops.select("up", "phi", "plo", "salt").distinct()
    owners = tree.select(F.col("depth").alias("up"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("owner"))
    attached = tops.join(wanted.join(owners, ["up", "phi", "plo"]), ["up", "phi", "plo", "salt"]).select(*NODE, "owner")

    nothing = hashlib.sha256(b"").hexdigest()
    return own.join(others, NODE, "left").join(attached, NODE, "left").join(_ends(rows), NODE, "left").select(
        *NODE, "conv_id", F.when(F.col("depth") > 0, F.coalesce("owner", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("own_tips") + F.col("later_tips") + F.coalesce("other_tips", F.lit(0))).alias("n_leaves"),
        (F.col("own_value") + F.col("later_value") + F.coalesce("other_value", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
