"""Language-model scores by a hidden Markov model over word classes, trained with Baum-Welch over partitions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import written

FLUSH_WORDS = 300_000
TOP_WORDS = 1 << 18
#: Words seen so often have a class of their own, as far as they are among the TOP_WORDS.
OWN_COUNT = 5
SHARED_CLASSES = 2047
#: At most; a model has a class per word with one of its own.
CLASSES = TOP_WORDS + SHARED_CLASSES + 1
SEGMENT = 256
BATCH_TOKENS = 1 << 18
SCORE_TOKENS = 1 << 21
ADD = 0.1
ENCODED = pa.schema([("uid", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("classes", pa.binary()), ("known", pa.int64()),
                     ("top_log", pa.float64()), ("class_log", pa.float64()), ("rare", pa.list_(pa.int64())), ("rare_n", pa.list_(pa.int64()))])
ENCODED_DDL = ("uid long, held_out boolean, n_tokens long, classes binary, known long, top_log double, class_log double, "
               "rare array<long>, rare_n array<long>")


class Model(NamedTuple):
    """Distributions of the first state of a text, of the first state of a later segment, transitions, and emissions (class by state)."""

    start: np.ndarray
    later: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Vocabulary(NamedTuple):
    """Training counts: the most frequent words one by one, all others by shared class.

    rank: place of a word's hash among the frequent; logs and classes by rank;
    within: log10 of what a shared class's words divide by.
    """

    rank: dict[int, int]
    log_count: np.ndarray
    class_of: np.ndarray
    within: np.ndarray
    class_count: np.ndarray
    tokens: int
    words: int
    texts: int


def signed_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n): 64-bit hashes of all words of the training texts and their counts, summed in tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array([signed_hash(w) for w in sums], pa.int64()), "n": pa.array(list(sums.values()), pa.int64())})
            sums.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                sums.update(words_of(text))
                if len(sums) >= FLUSH_WORDS:
                    yield flush()
        if sums:
            yield flush()

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> DataFrame:
    """The words from some count on, of which there are TOP_WORDS at most.

    The count is found from the numbers of words by magnitude, so no task
    sorts or gathers what all partitions have.
    """
    magnitude = F.floor(F.log2("n") * 16)
    sizes = sorted(counts.groupBy(magnitude.alias("m")).count().collect(), key=lambda r: -r["m"])  # 1,024 rows at most
    least, held = None, 0
    for r in sizes:
        held += r["count"]
        if held > TOP_WORDS:
            break
        least = r["m"]
    return counts.filter(magnitude >= least) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """What tasks need to know of the counts: at most TOP_WORDS frequent words and a number per class, whatever the size of the corpus."""
    top = frequent_words(counts).toArrow()
    word, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((word, -n))
    word, n = word[order], n[order]
    rows = counts.groupBy(F.pmod("word", F.lit(SHARED_CLASSES)).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total, distinct = np.zeros(SHARED_CLASSES), np.zeros(SHARED_CLASSES)
    for r in rows:
        total[r.c], distinct[r.c] = r.n, r.v
    tokens, words = int(total.sum()), int(distinct.sum())
    own = int((n >= OWN_COUNT).sum())
    np.subtract.at(total, word[:own] % SHARED_CLASSES, n[:own])
    np.subtract.at(distinct, word[:own] % SHARED_CLASSES, 1)
    classes = (own + word % SHARED_CLASSES).astype(np.uint32)
    classes[:own] = np.arange(own)
    by_class = np.concatenate([n[:own], total, [texts]]).astype(np.float64)
    return Vocabulary(dict(zip(word.tolist(), range(len(word)), strict=True)), np.log10(n + ADD), classes, np.log10(total + ADD * (distinct + 1)),
                      by_class, tokens + texts, words + bool(texts), texts)


class _Ranks(dict):
    """Rank of a word, -1 for others; only frequent words are kept."""

    def __init__(self, rank: dict[int, int]):
        super().__init__()
        self.rank = rank

    def __missing__(self, word: bytes) -> int:
        r = self.rank.get(signed_hash(word), -1)
        if r >= 0:
            self[word] = r
        return r


def encode(text: bytes | None, ranks: dict, vocab: Vocabulary) -> tuple:
    """(tokens, classes, known among the frequent, their log10(c + 0.1), log10 of words given their class without rare counts, rare words, their counts)."""
    words = words_of(text)
    own = len(vocab.class_count) - 1 - SHARED_CLASSES
    rank = np.fromiter(map(ranks.__getitem__, words), np.int64, len(words))
    common, missing = rank[rank >= 0], np.flatnonzero(rank < 0)
    hashes = [signed_hash(words[k]) for k in missing.tolist()]
    rare = Counter(hashes)
    classes = np.full(len(words) + 1, own + SHARED_CLASSES, np.uint32)
    classes[:-1][rank >= 0] = vocab.class_of[common]
    classes[missing] = own + np.array(hashes, np.int64) % SHARED_CLASSES
    shared = classes[:-1][classes[:-1] >= own] - own
    class_log = float(vocab.log_count[common[vocab.class_of[common] >= own]].sum() - vocab.within[shared].sum())
    return len(words) + 1, classes.astype("<u4").tobytes(), len(common), float(vocab.log_count[common].sum()), class_log, list(rare), list(rare.values())


def _ragged(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order from the longest, flat symbols, starts, and how many are longer than t for each t."""
    sizes = np.array(list(map(len, texts)))
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([texts[k] for k in order])
    sizes = sizes[order]
    starts = np.cumsum(sizes) - sizes
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
    return order, flat, starts, active


def log_likelihoods(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 probability of each whole sequence by the scaled forward recursion, all sequences a step at a time."""
    order, flat, starts, active = _ragged(texts)
    out = np.zeros(len(texts))
    state = np.broadcast_to(model.start, (len(texts), len(model.start)))
    for t, n in enumerate(active.tolist()):
        state = (state[:n] @ model.move if t else state[:n]) * model.emit.take(flat[starts[:n] + t], 0)
        scale = state.sum(1)
        out[:n] += np.log10(scale)
        state = state / scale[:, None]
    result = np.zeros(len(texts))
    result[order] = out
    return result


def expected_counts(segments: list[np.ndarray], first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts of a batch of segments: emissions, transitions, first states of texts and of later segments, log likelihood."""
    order, flat, starts, active = _ragged(segments)
    first, k = first[order], len(model.start)
    alphas, emits, scales, state, total = [], [], [], np.where(first[:, None], model.start, model.later), 0.0
    for t, n in enumerate(active.tolist()):
        emit = model.emit.take(flat[starts[:n] + t], 0)
        state = (state[:n] @ model.move if t else state[:n]) * emit
        scale = state.sum(1, keepdims=True)
        state = state / scale
        total += float(np.log10(scale).sum())
        alphas.append(state)
        emits.append(emit)
        scales.append(scale)
    moves = np.zeros((k, k))
    gammas, symbols = [], []
    beta = np.ones((len(segments), k))
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        if t + 1 < len(active):
            m = int(active[t + 1])
            after = emits.pop() * beta[:m] / scales[t + 1]
            moves += alphas[t][:m].T @ after
            beta[:m] = after @ model.move.T
        gammas.append(alphas[t] * beta[:n])
        symbols.append(flat[starts[:n] + t])
    gamma, symbol = np.concatenate(gammas), np.concatenate(symbols)
    # One count over (class, state), as the counts lie in memory.
    cell = (symbol.astype(np.int64) * k)[:, None] + np.arange(k)
    emissions = np.bincount(cell.ravel(), weights=gamma.ravel(), minlength=model.emit.size).reshape(-1, k)
    at_start = gammas[-1]
    return emissions, moves * model.move, at_start[first[:len(at_start)]].sum(0), at_start[~first[:len(at_start)]].sum(0), total


def _baum_welch(encoded: DataFrame, model: Model) -> tuple[np.ndarray, float]:
    """Summed counts over all training texts: rows for classes, states, first and later starts."""
    spark = encoded.sparkSession
    size_of, k = model.emit.shape
    shared = spark.sparkContext.broadcast(model)
    names = [f"s{s}" for s in range(k)]
    schema = pa.schema([("row", pa.int32()), *((s, pa.float64()) for s in names)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size_of + k + 3, k))
        held, first, size = [], [], 0

        def add() -> None:
            emissions, moves, starts, later, total = expected_counts(held, np.array(first), shared.value)
            sums[:size_of] += emissions
            sums[size_of:size_of + k] += moves
            sums[size_of + k:size_of + k + 2] += starts, later
            sums[size_of + k + 2, 0] += total

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                text = np.frombuffer(raw, "<u4")
                for at in range(0, len(text), SEGMENT):
                    held.append(text[at:at + SEGMENT])
                    first.append(at == 0)
                    size += len(held[-1])
                    if size >= BATCH_TOKENS:
                        add()
                        held, first, size = [], [], 0
        if held:
            add()
        # Multiples of 1/4096: the rest of a double would be noise that the shuffle can't compress.
        sums[:size_of] = np.rint(sums[:size_of] * 4096) / 4096
        at = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(sums[at, s]) for s in range(k))], schema=schema)

    rows = encoded.filter("NOT held_out").select("classes").mapInArrow(count, "row int, " + ", ".join(f"{s} double" for s in names))
    summed = rows.groupBy("row").agg(*(F.sum(s).alias(s) for s in names)).toArrow()  # a row per class and state at most
    out = np.zeros((size_of + k + 3, k))
    out[summed.column("row").to_numpy()] = np.stack([summed.column(s).to_numpy() for s in names], axis=1)
    return out[:-1], float(out[-1, 0])


def _first_model(vocab: Vocabulary, states: int, seed: int) -> Model:
    """States that last, with emissions far enough apart for few rounds to part them."""
    random = np.random.RandomState(seed)
    prior = (vocab.class_count + 0.5) / (vocab.class_count + 0.5).sum()
    emit = prior[:, None] * random.exponential(1.0, (len(prior), states))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    flat = np.full(states, 1 / states)
    return Model(flat, flat, move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _next_model(sums: np.ndarray, vocab: Vocabulary, prior_weight: float = 100.0) -> Model:
    """Normalised counts; a little of the class distribution goes to every state, so no sequence is impossible."""
    k, size = sums.shape[1], len(vocab.class_count)
    prior = (vocab.class_count + 0.5) / (vocab.class_count + 0.5).sum()
    emit = sums[:size] + prior_weight * prior[:, None]
    move, start, later = sums[size:size + k] + 1 / k, sums[size + k] + 1 / k, sums[size + k + 1] + 1 / k
    return Model(start / start.sum(), later / later.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def score_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", states: int = 8, rounds: int = 4, folds: int = 10,
                seed: int = 7) -> DataFrame:
    """Scores of all texts by a model of those that aren't held out.

    Returns (id, held_out, n_tokens, n_known, train_tokens, base_score, score).
    Held out are ids whose crc32 as text is 0 modulo `folds` (a null id counts
    as empty text). Tokens are words with A-Z in lower case, then one end.

    base_score: the log10 probability under counts plus 0.1. score: that of
    the hidden Markov model. Its states emit classes: one for each of the
    TOP_WORDS most frequent words that occurs OWN_COUNT times or more, for the
    end, and SHARED_CLASSES for all other words by hash; a word of a shared class follows with its share of
    the class's counts plus 0.1, an unseen word as one more of the class. The
    probabilities of all texts sum to one, whatever words they hold.

    Training counts all words (their table grows with the corpus), then runs
    `rounds` Baum-Welch rounds; each partition adds up expected counts over
    segments of SEGMENT tokens, and Spark sums them by class. Scores use the
    forward recursion over whole texts. Tasks get the TOP_WORDS most frequent
    words; all others are looked up by a join on their hash, which by then no
    word can dominate.

    A null or empty text is one end token. Repeated rows and equal or null ids
    are scored row by row; without training texts nothing is known and the
    model stays as it began; an empty table gives no rows.
    """
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"), (crc % folds == 0).alias("held_out"))
    train = rows.filter("NOT held_out")
    counts = written(count_words(train.select("body")), "word-counts")
    vocab = vocabulary(counts, train.count())
    shared = spark.sparkContext.broadcast(vocab)
    schema = pa.schema([docs.select(doc_id).limit(0).toArrow().schema.field(0).with_name("doc_id"), *ENCODED])

    def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, uid = _Ranks(shared.value.rank), TaskContext.get().partitionId() << 40
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found = [encode(t, ranks, shared.value) for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array(range(uid, uid + len(found)), pa.int64()), part.column(2), *(
                    pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(ENCODED)[2:], strict=True))]
                uid += len(found)
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    encoded = written(rows.mapInArrow(encoded_rows, f"doc_id {id_type}, {ENCODED_DDL}"), "encoded")
    model = _first_model(vocab, states, seed)
    for _ in range(rounds if vocab.texts else 0):
        model = _next_model(_baum_welch(encoded, model)[0], vocab)
    final = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def forward(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out, held, size = [], [], 0
            for raw in batch.to_pylist():
                held.append(np.frombuffer(raw, "<u4"))
                size += len(held[-1])
                if size >= SCORE_TOKENS:
                    out.append(log_likelihoods(held, final.value))
                    held, size = [], 0
            if held:
                out.append(log_likelihoods(held, final.value))
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    scored = encoded.select("doc_id", "uid", "held_out", "n_tokens", "known", "top_log", "class_log", forward("classes").alias("hmm_log"))
    rare = encoded.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("uid", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times"))
    found = rare.join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("rare_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    end_log, all_log = float(np.log10(vocab.texts + ADD)), float(np.log10(vocab.tokens + ADD * (vocab.words + 1)))
    return scored.join(found, "uid", "left").select(
        F.col("doc_id").alias(doc_id), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(vocab.texts > 0)).cast("long").alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("top_log") + rare_log + F.lit(end_log) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("hmm_log") + F.col("class_log") + rare_log).alias("score"))
