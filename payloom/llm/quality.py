"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus, and plain counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import batches_of, fresh_name, written

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
FOLLOWING = bytes(range(0x80, 0xC0))
JUDGED = ("struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, "
          "base_failed: boolean, score: double, kept: boolean>")
JUDGED_ARROW = pa.struct([*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                          ("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())])


class Ratios(NamedTuple):
    """The log ratio of both multinomials for each bucket, and how n-grams are hashed."""

    n: int
    bits: int
    log_ratio: np.ndarray


def buckets(text: bytes, n: int, bits: int) -> np.ndarray:
    """Bucket of each n-gram of bytes of the text: FNV steps, then the top bits of a product."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(a) < n:
        return np.zeros(0, np.uint32)
    h = np.zeros(len(a) - n + 1, np.uint32)
    for k in range(n):
        h = h * np.uint32(0x01000193) ^ a[k:len(a) - n + 1 + k]
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    pairs = a[:-1] * len(ids) + a[1:]
    if len(ids) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * len(ids) + a[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:len(words) - 2 + k] |= twice
    return int(inside.sum())


def judge(text: bytes, ratios: Ratios, threshold: float, min_words: int, max_repeat: int) -> dict:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = repeat_words(words)
    found = buckets(text, ratios.n, ratios.bits)
    score = float(ratios.log_ratio[found].mean()) if len(found) else 0.0
    failed = len(words) < min_words or 100 * repeated > max_repeat * len(words)
    return {
        "n_words": len(words), "word_chars": len(text.translate(None, BLANKS + FOLLOWING)),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated, "base_failed": failed, "score": score, "kept": not failed and score >= threshold}


def fit_ratios(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 3, bits: int = 16,
               smoothing: float = 1.0, max_trusted: int = 200_000, language: str | None = None, distinct: bool = False) -> Ratios:
    """Multinomials over hashed n-grams: of the whole raw corpus, and of its documents that labels trust.

    Trusted are documents with quality 1 that aren't toxic. About
    `max_trusted` labelled ids are used, the first by a hash, so that the
    ids that tasks get are bounded; raw counts always cover every text.
    Each task sums counts before the shuffle, and only a row per bucket
    reaches the driver.

    distinct: each text of a language counts once however many rows hold it,
    as trusted if any of them is, so that copies don't make a text's own
    n-grams look common. A task sends one row of each text it has at most.
    language: a column by which raw counts are weighted to the shares that
    languages have of the trusted texts. The ratio then doesn't depend on
    these shares: what only languages without trusted texts have is neutral,
    and their texts are judged by n-grams that others have too (symbols, cases,
    layout). Tasks hold two counts per bucket and language.
    """
    spark = docs.sparkSession
    trusted = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    labelled = trusted.count()
    if labelled > max_trusted:
        trusted = trusted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(max_trusted / labelled * (1 << 32)))
    ids = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in trusted.toLocalIterator()], np.int64)))
    size = 1 << bits
    marks = pa.schema([("digest", pa.binary()), ("language", pa.string()), ("trusted", pa.bool_()), ("body", pa.binary())])
    schema = pa.schema([("language", pa.string()), ("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whether texts are trusted; of equal ones the first alone, if only distinct ones count."""
        def rows() -> Iterator[tuple]:
            seen: set[tuple] = set()
            for batch in batches:
                member = np.isin(batch.column(0).fill_null(0).to_numpy(), ids.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                for body, group, is_trusted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), member.tolist(), strict=True):
                    body, digest = body or b"", b""
                    if distinct:
                        digest = hashlib.blake2b(body, digest_size=16).digest()
                        if (digest, group, is_trusted) in seen:
                            continue
                        seen.add((digest, group, is_trusted))
                    yield digest, group, is_trusted, body

        return batches_of(rows(), marks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        seen: tuple[set, set] = set(), set()
        for batch in batches:
            parts: dict[str, tuple[list, list]] = {}
            for digest, group, is_trusted, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = [k for k in range(1 + is_trusted) if not distinct or (digest, group) not in seen[k]]
                if new:
                    found = buckets(body, n, bits)
                    for k in new:
                        parts.setdefault(group, ([], []))[k].append(found)
                        if distinct:
                            seen[k].add((digest, group))
            for group, both in parts.items():
                into = sums.setdefault(group, (np.zeros(size, np.int64), np.zeros(size, np.int64)))
                for k in range(2):
                    if both[k]:
                        into[k][:] += np.bincount(np.concatenate(both[k]), minlength=size)
        for group, (raw, target) in sums.items():
            at = np.flatnonzero(raw)
            yield from batches_of(zip([group] * len(at), at.tolist(), raw[at].tolist(), target[at].tolist(), strict=True), schema)

    group = F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")) if language else F.lit("")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"), group.alias("language"))
    counted = "language string, bucket int, raw long, target long"
    if distinct:
        found = rows.mapInArrow(marked, "digest binary, language string, trusted boolean, body binary").repartition("digest").mapInArrow(count, counted)
    else:
        found = rows.mapInArrow(lambda batches: count(marked(batches)), counted)
    sums = written(found.groupBy("language", "bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")), "bucket-counts")
    # Each language's raw counts with its target's sum: a small target is as close to the corpus as a large one.
    share = sums.groupBy("language").agg((F.sum("target") / F.sum("raw")).alias("share"))
    weighted = F.array_sort(F.collect_list(F.col("raw") * F.col("share")))  # in one order, so that sums don't differ between runs
    both = sums.join(share, "language").groupBy("bucket").agg(
        F.aggregate(weighted, F.lit(0.0), lambda a, b: a + b).alias("scaled"), F.sum("target").alias("target"))
    scaled, target = np.zeros(size), np.zeros(size)
    for r in both.collect():  # at most 2 ** bits rows
        scaled[r.bucket], target[r.bucket] = r.scaled, r.target
    if not target.sum():
        return Ratios(n, bits, np.zeros(size))
    return Ratios(n, bits, np.log(target + smoothing) - np.log(scaled + smoothing))


def judge_quality(docs: DataFrame, ratios: Ratios, *, text: str = "text", threshold: float = -0.3, min_words: int = 50,
                  max_repeat: int = 50, name: str = "quality") -> DataFrame:
    """The documents with all their columns and a struct `name` of counts, score and verdict.

    score: mean log ratio over all n-grams of the whole text, so it doesn't
    depend on length; 0 for texts with fewer bytes than an n-gram. kept: not
    base_failed and score >= threshold, the same for every document. Prose
    scores about 0, without `language` in fit_ratios a little above or below as its language is more
    or less frequent among trusted texts than in the corpus; strange symbols, cases and
    layouts score below -1. The default lies between the two.

    base_failed: fewer than `min_words` words, or more than `max_repeat`
    percent of them in three-word windows found twice. Null texts count as
    empty ones. Repeated rows get equal verdicts. Without a trusted document
    all scores are 0. If a column is named `name`, underscores go before the
    new one's name.
    """
    table = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf(JUDGED)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array((judge(t or b"", table.value, threshold, min_words, max_repeat) for t in texts.to_pylist()), JUDGED_ARROW)

    return docs.withColumn(fresh_name(docs, name), judged.asNondeterministic()(F.col(f"`{text}`").cast("binary")))
