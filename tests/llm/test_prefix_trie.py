import hashlib
import random
import re
import zlib

import pytest

import payloom.llm.prefix_trie as trie_module
import payloom.llm.queries as q
from payloom.llm.ranking import MODULUS, product, ranked


def plain(rows):
    """The contract in plain Python: rows (conv_id, turn, role, text)."""
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        k = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:k] + own[c][k:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(x) == len(p) + 1 and x[:len(p)] == p for x in below)]
        saved = sum((len(nodes[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p in below)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(path))))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run_query(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "conv_id AS pos", "text AS hi", "1 AS depth", "2 AS words", "3 AS q0", "4 AS chunk", "5 AS pid")
    monkeypatch.setattr(q, "table", lambda spark, sf, name: df)
    return sorted((tuple(r) for r in q.op13_prefix_trie(spark, "").collect()), key=repr)


def dialogue(seed, n_convs, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n_convs):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_the_contract(spark, monkeypatch, seed):
    rows = dialogue(seed, 130, ["a", "b c", "", None, "long " * 2000])
    rows += [(7, None, "user", "before"), (7, 3, "user", "twice"), (7, 3, "user", "twice"), (None, 1, "user", "lost")]
    assert run_query(spark, rows, monkeypatch) == plain(rows)


def test_small_chunks_and_pieces_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "CHUNK", 4)
    rows = [(c, t, "user", f"word {t % 3}") for c in (0, 1, 2, 21, 40) for t in range(60)] + [(c, 0, "user", "alike") for c in range(100, 160)]
    assert run_query(spark, rows, monkeypatch) == plain(rows)


def test_one_end_for_more_conversations_than_a_piece_holds(spark, monkeypatch):
    rows = [(c, t, "user", "same") for c in range(9500) for t in range(4)] + [(20000, 0, "user", "other")]
    built = run_query(spark, rows, monkeypatch)
    assert {r[7] for r in built if r[1] == 4 and r[0] == 0} == {hashlib.sha256(",".join(map(str, range(9500))).encode()).hexdigest()}


def test_empty_table(spark, monkeypatch):
    assert run_query(spark, [], monkeypatch) == []


def test_clashing_fingerprints_lead_to_another_base(spark, monkeypatch):
    # Base 1 adds turns up, whatever their order: the same turns the other way round clash.
    rows = [(c, t, "user", text) for c in range(60) for t, text in enumerate(["x", "y"] if c % 2 else ["y", "x"])]
    tried = []
    monkeypatch.setattr(trie_module, "bases", lambda: (tried.append(b) or b for b in (1, MODULUS - 12345)))
    assert run_query(spark, rows, monkeypatch) == plain(rows) and len(tried) == 2
    monkeypatch.setattr(trie_module, "bases", lambda: iter([1]))
    with pytest.raises(RuntimeError):
        run_query(spark, rows, monkeypatch)


def test_products_are_associative():
    rng = random.Random(3)
    parts = [(rng.randrange(MODULUS), rng.randrange(1, 9)) for _ in range(30)]
    base = rng.randrange(MODULUS)

    def put(a, b):
        return product(a[0], b[0], b[1], base), a[1] + b[1]

    for a, b, c in zip(parts, parts[1:], parts[2:]):
        assert put(put(a, b), c) == put(a, put(b, c))


def test_ranks_go_on_from_task_to_task(spark):
    rows = [(None if k % 3 == 0 else "hot" if k % 3 == 1 else f"k{k}", (k * 7919) % 5000) for k in range(5000)]
    df = spark.createDataFrame(rows, "key string, v long").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = ranked(df, "key", ["v"], "test-ranks").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    groups = {}
    for r in found:
        groups.setdefault(r["key"], []).append((r["v"], r["pos"]))
    assert len(found) == 5000
    for group in groups.values():
        assert [p for _, p in sorted(group)] == list(range(len(group)))
