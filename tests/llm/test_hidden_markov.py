import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from payloom.llm import hidden_markov as hm


def base(rows):
    counts = Counter()
    for doc, text in rows:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 10:
            counts.update((text or "").encode().lower().split())
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        t = [*(text or "").encode().lower().split(), "end"]
        out.append((doc, zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0, len(t), sum(counts[w] > 0 for w in t), n,
                    sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)))
    return sorted(out, key=repr)


def check(df, rows):
    got = sorted((tuple(r)[:7] for r in hm.score_texts(df, rounds=2).collect()), key=repr)
    want = base(rows)
    assert [g[:5] for g in sorted(got, key=lambda g: repr(g[:5]))] == [w[:5] for w in sorted(want, key=lambda w: repr(w[:5]))]
    for g, w in zip(sorted(got, key=lambda g: (repr(g[:5]), g[5])), sorted(want, key=lambda w: (repr(w[:5]), w[5]))):
        assert abs(g[5] - w[5]) <= 1e-9 * abs(w[5]) + 1e-9 and math.isfinite(g[6]) and g[6] <= 1e-9


def test_table_and_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(df, [tuple(r) for r in df.select("doc_id", "text").collect()])
    held = [r for r in hm.score_texts(df).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("small", [False, True])
def test_edge_cases(docs, monkeypatch, small):
    """Also with so few frequent words that most are looked up by the join."""
    if small:
        monkeypatch.setattr(hm, "TOP_WORDS", 3)
    rows = [(i, f"the cat {'sat ' * (i % 4)} on w{i}") for i in range(40)] + [(100, None), (101, ""), (102, "Zzz unseen"), (None, "the The"), (5, "again"), (5, "again"),
                                                                             (103, "long text " * 40000), (104, "a\u00a0b É é")]
    check(docs(rows), rows)


def test_empty_tables(docs):
    assert hm.score_texts(docs([])).count() == 0
    check(docs([(k, "a b") for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0][:3]), [(k, "a b") for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0][:3])


def model(k, seed=0):
    r = np.random.RandomState(seed)
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    emit = np.zeros((hm.CLASSES, k))
    emit[:4] = norm(r.rand(4, k), 0)
    return hm.Model(norm(r.rand(k), 0), norm(r.rand(k), 0), norm(r.rand(k, k), 1), emit)


def test_forward_and_counts_against_all_paths():
    m, k = model(3), 3
    texts = [np.array(t, np.uint16) for t in ([0], [1, 2, 3], [3, 3, 0, 1, 2], [2, 0])]
    got = hm.log_likelihoods(texts, m)
    first = np.array([True, False, True, False])
    emissions, moves, starts, later, total = np.zeros((hm.CLASSES, k)), np.zeros((k, k)), np.zeros(k), np.zeros(k), 0.0
    for j, t in enumerate(texts):
        for begin, check_only in ((m.start, True), (m.start if first[j] else m.later, False)):
            paths = {p: begin[p[0]] * m.emit[t[0], p[0]] * math.prod(m.move[a, b] * m.emit[s, b] for a, b, s in zip(p, p[1:], t[1:])) for p in product(range(k), repeat=len(t))}
            z = sum(paths.values())
            if check_only:
                assert abs(got[j] - math.log10(z)) < 1e-9
                continue
            total += math.log10(z)
            for p, w in paths.items():
                (starts if first[j] else later)[p[0]] += w / z
                for s, a in zip(t, p):
                    emissions[s, a] += w / z
                for a, b in zip(p, p[1:]):
                    moves[a, b] += w / z
    found = hm.expected_counts(texts, first, m)
    for a, b in zip(found, (emissions, moves, starts, later, total)):
        assert np.allclose(a, b)


def test_rounds_raise_the_likelihood(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scores = [sum(r.score for r in hm.score_texts(df, rounds=n).collect() if not r.held_out) for n in (1, 3, 6)]
    assert scores[0] < scores[1] < scores[2]


def test_expected_counts_look_emissions_up_once():
    """The backward pass takes what the forward pass has looked up; counts equal those over all paths."""
    import itertools

    from payloom.llm import hidden_markov as hm

    class Table(np.ndarray):
        reads = 0

        def take(self, *args, **kwargs):
            Table.reads += 1
            return np.asarray(self).take(*args, **kwargs)

        def __getitem__(self, at):
            Table.reads += 1
            return np.asarray(self)[at]

    random = np.random.RandomState(2)
    emit, move = random.rand(5, 2), random.rand(2, 2)
    start, later = np.array([0.3, 0.7]), np.array([0.6, 0.4])
    texts = [np.array([1, 4, 1], "<u4"), np.array([0, 2], "<u4")]
    counts, moves, _, _, total = hm.expected_counts(texts, np.array([True, False]), hm.Model(start, later, move, emit.view(Table)))
    assert Table.reads == 3
    want, want_moves, logs = np.zeros((5, 2)), np.zeros((2, 2)), 0.0
    for text, first in zip(texts, (start, later)):
        paths = list(itertools.product(range(2), repeat=len(text)))
        weights = [first[p[0]] * np.prod([move[a, b] for a, b in zip(p, p[1:])]) * np.prod([emit[c, s] for c, s in zip(text, p)]) for p in paths]
        logs += np.log10(sum(weights))
        for p, w in zip(paths, weights):
            for c, s in zip(text, p):
                want[c, s] += w / sum(weights)
            for a, b in zip(p, p[1:]):
                want_moves[a, b] += w / sum(weights)
    assert np.allclose(counts, want) and np.allclose(moves, want_moves) and np.isclose(total, logs)
