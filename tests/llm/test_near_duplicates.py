import random

import numpy as np
import pytest

from payloom.llm.components import connected_components
from payloom.llm.near_duplicates import Rule, may_link, minhashes, near_duplicates, odd_sketch, parity, shingles


def brute(rows, words=2, percent=80):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if rows[i][0] == rows[j][0] or (a and b and 100 * len(a & b) >= percent * len(a | b)):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, len(s), least[root(i)] if d is not None else None, d is None or least[root(i)] == d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df, rule=Rule()):
    return sorted(map(tuple, near_duplicates(df, rule).collect()), key=repr)


def test_edge_cases(docs):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(5, None), (3, ""), (9, " \n"), (4, "One"), (2, "one"), (None, "one"), (7, "a b"), (8, "A\tB"), (8, "A\tB"), (10, "a\u00a0b"),
            (11, long), (12, long + " tail"), (13, "x " * 500), (14, "x x"), (6, "İ b"), (15, "i̇ b")]
    assert got(docs(rows)) == brute(rows)


def test_empty_table(docs):
    assert got(docs([])) == []


def test_groups_of_edited_copies(docs):
    """Chains and stars around the limit: only links between components may decide."""
    r = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"v{r.randrange(900)}" for _ in range(120)]
        for _ in range(40):
            copy = list(base)
            for _ in range(r.randrange(0, 14)):
                copy[r.randrange(len(copy))] = f"n{r.randrange(10 ** 6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    assert got(docs(rows)) == brute(rows)


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(df) == brute(rows)
    assert got(df, Rule(words=5)) == brute(rows, words=5)


def test_odd_sketches_estimate_high_similarities():
    rule = Rule(bands=64, rows=8)
    s = shingles(" ".join(map(str, range(2000))).encode(), 2, {str(k).encode(): k * 7919 + 1 for k in range(3000)})
    for cut in (20, 100, 300):
        other = np.sort(np.append(s[cut:], np.arange(cut, dtype=np.uint64)))
        true = (len(s) - cut) / (len(s) + cut)
        x = int(np.bitwise_count(np.frombuffer(odd_sketch(minhashes(s, 512)), np.uint8) ^ np.frombuffer(odd_sketch(minhashes(other, 512)), np.uint8)).sum())
        estimate = 1 + 512 / (4 * 512) * np.log(1 - 2 * x / 512)
        assert abs(estimate - true) < 0.06, (cut, estimate, true)
        bits = int(np.bitwise_count(np.frombuffer(parity(s), np.uint8) ^ np.frombuffer(parity(other), np.uint8)).sum())
        assert bits <= 2 * cut
    n = np.array([len(s)])
    odd = np.frombuffer(odd_sketch(minhashes(s, rule.samples)), np.uint64)[None]
    assert may_link(n, n, odd, odd, [parity(s)], [parity(s)], rule)[0]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(60, 61), (61, 62), (63, 60)]])
def test_components(spark, edges):
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert found == {x: root(x) for x in parent}
