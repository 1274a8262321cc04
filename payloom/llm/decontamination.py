"""Benchmark passages in documents, found by Wu-Manber search for many windows at once."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import fresh_name, kept_one

BLOCK_BYTES = 4 << 20
TABLE_BITS = 20
#: A-Z in lower case, all other ASCII characters but digits and letters to blanks; other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
FOUND = "struct<n_words: bigint, spans: array<struct<begin: bigint, end: bigint>>, items: array<string>>"
FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


class WuManber:
    """Search for strings of any lengths from the shortest one, `m`.

    A table has, for the hash of a block of bytes, how far the search may move
    on: the least distance of such a block from the end of any string's first
    m bytes. Where that is 0, the strings of that suffix hash are compared.
    Colliding hashes only shorten moves. The block is long enough that few
    blocks of a text are in the table by chance.
    """

    def __init__(self, strings: list[bytes]):
        self.m = m = min(map(len, strings))
        self.block = b = min(m, max(2, math.ceil(math.log(2 * m * len(strings)) / math.log(6))))
        self.farthest = min(m - b + 1, 255)
        self.mask = (1 << TABLE_BITS) - 1
        self.shift = bytearray([self.farthest]) * (1 << TABLE_BITS)
        self.buckets: dict[int, list[int]] = {}
        self.strings = strings
        for k, s in enumerate(strings):
            for end in range(b, m + 1):
                at = hash(s[end - b:end]) & self.mask
                if m - end < self.shift[at]:
                    self.shift[at] = m - end
            self.buckets.setdefault(hash(s[m - b:m]) & self.mask, []).append(k)

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, string number) of every occurrence."""
        m, b, shift, mask, buckets, strings = self.m, self.block, self.shift, self.mask, self.buckets, self.strings
        end, n = m, len(text)
        while end <= n:
            at = hash(text[end - b:end]) & mask
            move = shift[at]
            if move:
                end += move
                continue
            for k in buckets.get(at, ()):
                if text.startswith(strings[k], end - m):
                    yield end - m, k
            end += 1


class Matcher:
    """All windows of a set of items; a search for each number of words, so that short items don't shorten the moves."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        owners: dict[int, dict[bytes, set]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for k in range(len(words) - size + 1 if size else 0):
                owners.setdefault(size, {}).setdefault(b" " + b" ".join(words[k:k + size]) + b" ", set()).add(item)
        self.searches = [(size, WuManber(list(found)), [sorted(x for x in o if x is not None) for o in found.values()])
                         for size, found in sorted(owners.items())]

    def find(self, words: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> list[tuple[int, int]]:
        """The hit word ranges, united with the given ones; adds to `items`."""
        text = b" " + b" ".join(words) + b" "
        hits = []
        for size, search, owners in self.searches:
            at = word = 0
            for place, k in search.search(text):
                word += text.count(b" ", at, place)
                at = place
                hits.append((word, word + size))
                items.update(owners[k])
        united: list[tuple[int, int]] = []
        for begin, end in sorted(hits + spans):
            if united and begin <= united[-1][1]:
                if end > united[-1][1]:
                    united[-1] = (united[-1][0], end)
            else:
                united.append((begin, end))
        return united


def _finder(items, window: int, first: bool):
    """Arrow function over texts, and what earlier blocks of items found in them."""
    key = uuid.uuid4().hex

    def matcher() -> Matcher:
        """Built once in a worker process, for all its tasks."""
        return kept_one((Matcher, key), lambda: Matcher(items.value, window))

    def rows(texts: list, before: list):
        search = matcher()
        for text, old in zip(texts, before, strict=True):
            words = words_of(text)
            found = set(old["items"]) if old else set()
            spans = search.find(words, [(s["begin"], s["end"]) for s in old["spans"]] if old else [], found)
            yield {"n_words": len(words), "spans": [{"begin": a, "end": z} for a, z in spans], "items": sorted(found)}

    if first:
        @F.arrow_udf(FOUND)
        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pa.array(rows(texts.to_pylist(), [None] * len(texts)), FOUND_ARROW)
    else:
        @F.arrow_udf(FOUND)
        def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, before in batches:
                yield pa.array(rows(texts.to_pylist(), before.to_pylist()), FOUND_ARROW)
    return find.asNondeterministic()


def find_passages(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = 10, name: str = "passages") -> DataFrame:
    """The documents with all their columns and a struct `name` of what benchmark text they hold.

    n_words: words of the document; spans: disjoint word ranges [begin, end)
    that occurrences of item windows cover; items: ids of the items that
    occur, as strings, sorted. A window is `window` consecutive words of an
    item, or all words of a shorter item that has any.

    The benchmark is the query set: it is split by a hash of the item id into
    blocks of about BLOCK_BYTES of text, one block at a time is broadcast, and
    each is searched for in whole documents, without a shuffle.

    Null or empty texts have no words and no hits; items without words are
    never found; without items nothing is hit. Windows of an item without id
    count as hits, but are named by no id. Repeated rows get equal results.
    If a column is named `name`, underscores go before the new one's name.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    name = fresh_name(docs, name)
    bodies = F.col(f"`{text}`").cast("binary")
    for k in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k) if blocks > 1 else rows
        items = spark.sparkContext.broadcast([(r.item, bytes(r.body or b"")) for r in own.distinct().toLocalIterator()])
        docs = docs.withColumn(name, _finder(items, window, True)(bodies) if k == 0 else _finder(items, window, False)(bodies, F.col(name)))
    return docs


def hit_words(passages: str):
    """Number of words in the spans of a struct of find_passages."""
    return F.aggregate(f"{passages}.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
