"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit, a ratio of two
multinomials over hashed n-grams of bytes, tells languages with that bit from those
without it. A text's language is the codeword with the least loss, where
each bit counts as much as its classifier was right on that language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import fresh_name, written

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BITS = 16
#: Texts are read in windows of so many bytes; each n-gram lies in exactly one.
WINDOW = 1 << 16
#: N-grams that wait to be counted together.
COUNTED = 1 << 20
#: Languages that a task counts at the same time before it sends its sums on.
HELD = 32
#: Hadamard codes serve so many languages; beyond, codewords of 256 bits are hashed from the names.
MOST = 255
#: Everything but ASCII letters and bytes beyond ASCII becomes a blank, A-Z become small.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
IDENTIFIED = "struct<lang: string, score: double, bit_errors: int, ambiguous: boolean>"
IDENTIFIED_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bit_errors", pa.int32()), ("ambiguous", pa.bool_())])


class Codebook(NamedTuple):
    """Languages with their codewords of -1 and 1, the classifiers' weights by bucket, and what each bit is worth to each language."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    worth: np.ndarray


def codewords(languages: list[str]) -> np.ndarray:
    """A row of -1 and 1 for each language.

    Rows of a Hadamard matrix differ in half of their places. Bits that are
    equal for all languages, or equal or opposite to another bit, tell nothing and are left out.
    """
    n = len(languages)
    if n > MOST:
        drawn = [np.unpackbits(np.frombuffer(hashlib.sha256(x.encode()).digest(), np.uint8)) for x in languages]
        return 2 * np.array(drawn, np.int8) - 1
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < max(n + 1, 8):
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    rows = matrix[1:n + 1]
    kept: dict[bytes, int] = {}
    for k in range(rows.shape[1]):
        column = rows[:, k] * (rows[0, k] if n else 1)
        if n and (column != 1).any():
            kept.setdefault(column.tobytes(), k)
    return np.ascontiguousarray(rows[:, sorted(kept.values())])


def grams(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, window by window; words are parted by one blank, one stands before and after the text."""
    body = b" " + b" ".join(text.translate(NORMAL).split()) + b" "
    if len(body) < 3:
        return
    most = max(ORDERS)
    for start in range(0, len(body), WINDOW):
        a = np.frombuffer(body, np.uint8, min(WINDOW + most - 1, len(body) - start), start).astype(np.uint32)
        own = min(WINDOW, len(body) - start)
        h = np.zeros(len(a), np.uint32)
        for k in range(most):
            left = len(a) - k
            if left <= 0:
                break
            h = h[:left] * np.uint32(0x01000193) ^ a[k:]
            if k + 1 in ORDERS:
                yield ((h[:own] + np.uint32(k)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def margins(text: bytes, weights: np.ndarray) -> np.ndarray:
    """What each bit's classifier says: the sum of its weights over the text's n-grams, by the square root of their number."""
    total, n = np.zeros(weights.shape[1]), 0
    for found in grams(text):
        total += weights[found].sum(0, dtype=float)
        n += len(found)
    return np.clip(total / np.sqrt(max(n, 1)), -30, 30)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def decode(margin: np.ndarray, book: Codebook) -> tuple[str, float, int, bool]:
    """Language of the least weighted logistic loss; ties go to the first in order."""
    if not book.words.shape[1]:
        return book.languages[0], 1.0, 0, False
    loss = (book.worth * np.logaddexp(0, -book.words * margin)).sum(1) * book.words.shape[1]
    best = int(loss.argmin())
    share = np.exp(loss[best] - loss)
    score = float(share[best] / share.sum())
    errors = int((book.words[best] * margin <= 0).sum())
    nearest = int((book.words != book.words[best]).sum(1)[np.arange(len(loss)) != best].min())
    return book.languages[best], score, errors, errors > (nearest - 1) // 2 or score < 0.5


def fit_codebook(docs: DataFrame, *, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Codebook:
    """Classifiers and decoding weights from all texts with a language.

    Rows without text or language teach nothing; equal rows count each. The multinomial of a bit's side is the mean
    of its languages', so a frequent language doesn't drown the others. One pass counts
    n-grams by language, one more counts how often each bit is right; tasks sum before the shuffle.
    The driver gets a row per bucket, and one per language: languages are a label set, not data.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").cast("binary").alias("body"))
    size = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums() -> pa.RecordBatch:
            some = {x: np.flatnonzero(a) for x, a in held.items()}
            return pa.RecordBatch.from_arrays([
                pa.array([x for x, at in some.items() for _ in range(len(at))], pa.string()),
                pa.array(np.concatenate([*some.values(), np.zeros(0, np.int64)]), pa.int32()),
                pa.array(np.concatenate([*(held[x][at] for x, at in some.items()), np.zeros(0, np.int64)]), pa.int64())], names=["lang", "bucket", "n"])

        def add() -> None:
            for x, parts in waiting.items():
                held[x] += np.bincount(np.concatenate(parts), minlength=size)
            waiting.clear()

        held: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        n = 0
        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if language not in held:
                    if len(held) == HELD:
                        add()
                        yield sums()
                        held.clear()
                    held[language] = np.zeros(size, np.int64)
                for found in grams(body):
                    waiting.setdefault(language, []).append(found)
                    n += len(found)
                    if n >= COUNTED:
                        add()
                        n = 0
        add()
        yield sums()

    counts = known.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = written(counts, "language-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    words = codewords(languages)
    n_bits = words.shape[1]
    weights = np.zeros((size, n_bits))
    if n_bits:
        every = np.array([totals[x] + smoothing * size for x in languages], float)
        sides = [words > 0, words < 0]
        # Share of a language's n-grams in each bucket, added up for the languages on both sides of each bit.
        rows = [(x, float(1 / every[i]), words[i].tolist()) for i, x in enumerate(languages)]
        codes = spark.createDataFrame(rows, "lang string, unit double, word array<int>")
        shares = counts.join(F.broadcast(codes), "lang").withColumn("share", F.col("n") * F.col("unit"))
        sums = [F.sum(F.when(F.col("word")[b] == s, F.col("share"))) for b in range(n_bits) for s in (1, -1)]
        found = np.zeros((size, 2 * n_bits))
        for bucket, values in shares.groupBy("bucket").agg(F.array(*[F.coalesce(F.round(x, 12), F.lit(0.0)) for x in sums]).alias("sums")).collect():
            found[bucket] = values
        both = [(found[:, s::2] + (smoothing / every) @ side) / side.sum(0) for s, side in enumerate(sides)]
        weights = np.log(both[0] / both[1])
    book = Codebook(languages, words, weights.astype(np.float32), np.full(words.shape, 1 / max(n_bits, 1)))
    return book._replace(worth=_worth(known, book)) if n_bits else book


def _worth(known: DataFrame, book: Codebook) -> np.ndarray:
    """How often each bit is right on each language, as shares of the language's bits."""
    sent = known.sparkSession.sparkContext.broadcast(book)
    n_bits = book.words.shape[1]

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(sent.value.languages)}
        hits = np.zeros(sent.value.words.shape, np.int64)
        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                i = place.get(language)
                if i is not None:
                    hits[i] += sent.value.words[i] * margins(body, sent.value.weights) > 0
        some, bits = np.nonzero(hits)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(bits, pa.int32()), pa.array(hits[some, bits], pa.int64())], names=["i", "bit", "n"])

    hits = np.zeros((len(book.languages), n_bits))
    for i, bit, n in known.mapInArrow(right, "i int, bit int, n bigint").groupBy("i", "bit").agg(F.sum("n")).collect():
        hits[i, bit] = n
    sums = hits.sum(1, keepdims=True)
    return np.where(sums > 0, hits / np.maximum(sums, 1), 1 / n_bits)


def identify(docs: DataFrame, book: Codebook, *, text: str = "text", name: str = "language") -> DataFrame:
    """All rows and columns, with a struct (lang, score, bit_errors, ambiguous) under a name that is free.

    lang is a learned language, or `und` with score 0 where the text is null or has no
    letter, or nothing was learned. score is the share of the chosen codeword, from 0 to 1. ambiguous: more bits
    disagree with the codeword than the code corrects, or no codeword has half of the score, or no language was found.
    Only the text is looked at, all of it.
    """
    sent = docs.sparkSession.sparkContext.broadcast(book)

    @F.arrow_udf(IDENTIFIED)
    def judged(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            body = value.as_py()
            if body is None or not sent.value.languages or not has_letter(body):
                out.append((UNKNOWN, 0.0, 0, True))
            else:
                out.append(decode(margins(body, sent.value.weights), sent.value))
        return pa.array([dict(zip(("lang", "score", "bit_errors", "ambiguous"), r, strict=True)) for r in out], IDENTIFIED_ARROW)

    return docs.withColumn(fresh_name(docs, name), judged.asNondeterministic()(F.col(f"`{text}`").cast("binary")))


def crc_remainder(column: Column, by: int) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % by
