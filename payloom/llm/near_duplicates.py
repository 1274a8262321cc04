"""MinHash near-duplicates with odd sketches, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import batches_of, written
from payloom.llm.components import connected_components
from payloom.llm.pieces import memo_of

SKETCH_BITS = 512
#: What the memo of words may take; an entry takes 150 bytes besides its word.
MEMO_BYTES = 64 << 20
SALTS = 16
BLOCK = 4096
SIGNED = "struct<n: bigint, digest: binary, bands: array<bigint>, odd: binary, parity: binary>"
SIGNED_ARROW = pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("odd", pa.binary()), ("parity", pa.binary())])
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Rule(NamedTuple):
    """Shingles of `words` words; links where 100 * intersection >= percent * union.

    `bands` bands of `rows` samples each: a pair at 0.8 shares none with a
    probability of (1 - 0.8 ** 5) ** 32 = 3e-6. `slack`: how far below the
    limit the estimate of an odd sketch may be, 6 standard errors at 0.8.
    """

    words: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 5
    slack: float = 0.2

    @property
    def samples(self) -> int:
        return self.bands * self.rows


class WordHashes(dict):
    """64-bit hashes of words, kept while they take less than MEMO_BYTES; the others are hashed each time."""

    room = MEMO_BYTES

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if self.room > len(word):
            self[word] = h
            self.room -= len(word) + 150
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, words: int, memo: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; with fewer words, of all words as one."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.array([memo[w] for w in found], np.uint64)
    size = min(words, len(h))
    s = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        s = mixed(s * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - size + 1 + k])
    return np.unique(s)


def minhashes(s: np.ndarray, samples: int) -> np.ndarray:
    """The least of each of `samples` hashes over the set."""
    seeds = mixed(np.arange(1, samples + 1, dtype=np.uint64))
    factors, offsets = seeds.astype(np.uint32) | np.uint32(1), (seeds >> np.uint64(32)).astype(np.uint32)
    high, low = (s >> np.uint64(32)).astype(np.uint32), s.astype(np.uint32)
    least = np.full(samples, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(s), 1024):
        v = high[k:k + 1024, None] * factors
        v += offsets
        v ^= low[k:k + 1024, None]
        v *= np.uint32(0x85EBCA6B)
        v ^= v >> np.uint32(15)
        v *= np.uint32(0xC2B2AE35)
        np.minimum(least, v.min(0), out=least)
    return least


def odd_sketch(signature: np.ndarray) -> bytes:
    """Samples folded into a bitmap: a bit is set where an odd number of samples falls."""
    at = mixed(signature.astype(np.uint64) + (np.arange(len(signature), dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).tobytes()


def parity(s: np.ndarray) -> bytes:
    """The whole set folded the same way, into at least 4 bits per shingle; halves may be folded onto each other."""
    bits = 1 << max(9, int(4 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def sign(s: np.ndarray, rule: Rule) -> dict:
    if not len(s):
        return {"n": 0, "digest": None, "bands": [], "odd": None, "parity": None}
    signature = minhashes(s, rule.samples)
    bands = np.arange(rule.bands, dtype=np.uint64)
    for k in range(rule.rows):
        bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + signature[k::rule.rows])
    return {"n": len(s), "digest": hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "bands": bands.view(np.int64), "odd": odd_sketch(signature), "parity": parity(s)}


def most_odd_bits(rule: Rule) -> int:
    """Set bits in the XOR of two odd sketches that the limit less the slack allows."""
    differing = 2 * rule.samples * (1 - rule.percent / 100 + rule.slack)
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * differing / SKETCH_BITS)))


def _fold(rows: np.ndarray, width: int) -> np.ndarray:
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


class Parities:
    """Parity bitmaps of a block's nodes, by width, each also folded once: sizes of a link differ by less than a half."""

    def __init__(self, bitmaps: list[bytes]):
        self.width = np.array(list(map(len, bitmaps)))
        self.place = np.zeros(len(bitmaps), np.int64)
        self.folded_place = np.zeros(len(bitmaps), np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            wider = np.flatnonzero(self.width == 2 * w)
            rows = [np.frombuffer(b"".join(bitmaps[k] for k in own), np.uint8).reshape(len(own), w)]
            if len(wider):
                rows.append(_fold(np.frombuffer(b"".join(bitmaps[k] for k in wider), np.uint8).reshape(len(wider), 2 * w), w))
            self.rows[w] = np.concatenate(rows).view(np.uint64)
            self.place[own] = np.arange(len(own))
            self.folded_place[wider] = len(own) + np.arange(len(wider))

    def differing(self, k: int, others: np.ndarray) -> np.ndarray:
        """Bits in which the bitmap of k differs from each of the others, at the smaller width."""
        bits = np.zeros(len(others), np.int64)
        w = int(self.width[k])
        for width in (w, 2 * w, w // 2):
            at = np.flatnonzero(self.width[others] == width)
            if len(at):
                rows = self.rows[min(w, width)]
                own = rows[self.place[k] if width >= w else self.folded_place[k]]
                their = (self.folded_place if width > w else self.place)[others[at]]
                bits[at] = np.bitwise_count(rows[their] ^ own).sum(1)
        return bits


def may_link(n_a: np.ndarray, n_b: np.ndarray, odd_a: np.ndarray, odd_b: np.ndarray, par_a: list[bytes], par_b: list[bytes], rule: Rule) -> np.ndarray:
    """Which pairs go on to the check on whole sets.

    Sizes and parities only rule out what can't be a link: two sets differ in
    no fewer shingles than their parity bitmaps in bits. Odd sketches of
    samples estimate the similarity, with the rule's slack.
    """
    ok = 100 * np.minimum(n_a, n_b) >= rule.percent * np.maximum(n_a, n_b)
    ok &= np.bitwise_count(odd_a ^ odd_b).sum(1) <= most_odd_bits(rule)
    for k in np.flatnonzero(ok):
        a, b = np.frombuffer(par_a[k], np.uint8)[None], np.frombuffer(par_b[k], np.uint8)[None]
        width = min(a.shape[1], b.shape[1])
        bits = int(np.bitwise_count(_fold(a, width) ^ _fold(b, width)).sum())
        ok[k] = (100 + rule.percent) * bits <= (100 - rule.percent) * int(n_a[k] + n_b[k])
    return ok


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)


def _signatures(docs: DataFrame, doc_id: str, text: str, rule: Rule) -> DataFrame:
    @F.arrow_udf(SIGNED)
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = memo_of(WordHashes)
        for batch in batches:
            yield pa.array((sign(shingles(t, rule.words, memo), rule) for t in batch.to_pylist()), SIGNED_ARROW)

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), signed.asNondeterministic()(F.col(f"`{text}`").cast("binary")).alias("s"))
    return written(rows.select("doc_id", "s.*"), "signatures")


def _whole_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, rule: Rule) -> DataFrame:
    @F.arrow_udf("array<bigint>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = memo_of(WordHashes)
        for batch in batches:
            yield pa.array((shingles(t, rule.words, memo).view(np.int64) for t in batch.to_pylist()), pa.list_(pa.int64()))

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("node"), F.col(f"`{text}`").cast("binary").alias("body"))
    return written(rows.join(nodes, "node", "left_semi").select("node", hashed.asNondeterministic()("body").alias("shingles")), "shingles")


def _linked(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Of candidate pairs (a, b), those that are links."""
    @F.arrow_udf("boolean")
    def passes(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for n_a, n_b, odd_a, odd_b, par_a, par_b in batches:
            ok = may_link(n_a.to_numpy(), n_b.to_numpy(), _matrix(odd_a.to_pylist()), _matrix(odd_b.to_pylist()), par_a.to_pylist(), par_b.to_pylist(), rule) if len(n_a) else []
            yield pa.array(ok, pa.bool_())

    def side(s: str) -> DataFrame:
        return nodes.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "odd", "parity")))

    tried = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("ok", passes.asNondeterministic()("n_a", "n_b", "odd_a", "odd_b", "parity_a", "parity_b"))
    tried = written(tried.filter("ok").select("a", "b"), "candidates")
    both = tried.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(100 * common >= rule.percent * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def _across(rule: Rule, forest: bool):
    """For one block pair of a bucket: pairs of nodes in different components that may be links.

    With `forest`, only the most similar ones that would join all components
    they reach: a pair that others make needless isn't checked on whole sets.
    """
    def pairs(table: pa.Table) -> pa.Table:
        node, component, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        block = table.column("block").to_numpy()
        odd, par = _matrix(table.column("odd").to_pylist()), table.column("parity").to_pylist()
        one_block = table.column("i")[0] == table.column("j")[0]
        left = np.flatnonzero(block == table.column("i")[0].as_py())
        right = left if one_block else np.flatnonzero(block == table.column("j")[0].as_py())
        limit, found, parities = most_odd_bits(rule), [], Parities(par)
        for k in left:
            others = right[right > k] if one_block else right
            others = others[component[others] != component[k]]
            others = others[100 * np.minimum(n[others], n[k]) >= rule.percent * np.maximum(n[others], n[k])]
            others = others[np.bitwise_count(odd[others] ^ odd[k]).sum(1) <= limit]
            if len(others):
                bits = parities.differing(k, others)
                close = (100 + rule.percent) * bits <= (100 - rule.percent) * (n[others] + n[k])
                share = 1000 * bits[close] // (n[others[close]] + n[k])
                found.append(np.stack([np.full(len(share), k), others[close], share]))
        found = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        out, parent = [], {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for a, b in found[:2, np.argsort(found[2], kind="stable")].T.tolist():
            if forest and root(int(component[a])) == root(int(component[b])):
                continue
            out.append((int(node[a]), int(node[b])))
            parent[root(int(component[a]))] = root(int(component[b]))
        batches = list(batches_of(out, PAIRS))
        return pa.Table.from_batches(batches, PAIRS)

    return pairs


def _cross_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, rule: Rule, forest: bool) -> DataFrame:
    """Candidate pairs that are in one bucket and still in different components.

    Buckets that lie in one component are done. Larger ones are compared in
    blocks of BLOCK nodes, each pair of blocks a task's work of its own.
    """
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"))
    open_buckets = of.filter("least < most").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
                                                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = labelled.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(open_buckets, ["bucket", "salt"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    rows = rows.join(nodes.select("node", "n", "odd", "parity"), "node")
    found = rows.select("bucket", "i", "j", "block", "node", "component", "n", "odd", "parity").groupBy("bucket", "i", "j").applyInArrow(_across(rule, forest), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of near-duplicates: (id, n_shingles, component_id, kept), a row per document.

    Equal sets are one node. Nodes that share a band of MinHash samples are
    candidates; odd sketches sort out those below the limit, and links are
    confirmed on whole sets of 64-bit shingle hashes. A bucket is never
    expanded into all pairs: first every node is compared with the bucket's
    least node, then the nodes of still different components with each other,
    in two steps (a forest of the closest pairs, then what is left), so no
    link between components is lost to the size of a bucket.

    component_id: the least id that is reachable over links; kept: the
    document has that id. A text without words has an empty set, is linked
    with nothing and kept. Rows with a null id aren't linked, have no
    component and are kept. Rows with equal ids are one document: a link of
    any of their texts is a link of all. Repeated rows and an empty table give
    a row each and none. Other columns are not read.
    """
    signed = _signatures(docs, doc_id, text, rule)
    groups = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    groups = written(groups, "groups")
    nodes = signed.join(groups.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("node"), "n", "bands", "odd", "parity", "digest").dropDuplicates(["node", "digest"]).drop("digest")
    nodes = written(nodes, "nodes")

    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last")
    salted = shared.select("bucket", "centre", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = banded.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["bucket", "salt"]).select("bucket", "node", "centre")
    members = written(members, "members")
    sets = _whole_sets(docs, members.select("node").distinct(), doc_id, text, rule)

    pairs = members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    labels = connected_components(_linked(pairs, nodes, sets, rule))
    buckets = members.select("bucket", "node")
    for forest in (True, False):
        pairs = written(_cross_pairs(buckets, nodes, labels, rule, forest), "cross")
        if pairs.limit(1).count():
            # Links found so far are as good as an edge from each node to its component.
            labels = connected_components(_linked(pairs, nodes, sets, rule).unionByName(labels.toDF("a", "b")))

    named = groups.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.filter("copies > 1 OR component <> node").select("digest", "component", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = signed.select("doc_id", "n", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    rows = rows.join(named, ["digest", "salt"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))
