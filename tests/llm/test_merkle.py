import hashlib
import zlib

import numpy as np
import pytest

from payloom.llm.merkle import FANOUT, LEAVES, Block, address, audit, build_block, fold, layout, levels_of, merkle_manifest, node_count, unpacked
from payloom.llm.queries import op12_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """All levels over nodes (hexadecimal), and each node's siblings level by level."""
    levels, proofs, place = [nodes], [[] for _ in nodes], list(range(len(nodes)))
    while len(levels[-1]) > 1:
        row = levels[-1]
        for k, p in enumerate(place):
            run = row[p - p % FANOUT:p - p % FANOUT + FANOUT]
            proofs[k].append((run[:p % FANOUT], run[p % FANOUT + 1:]))
            place[k] = p // FANOUT
        levels.append([h(*row[k:k + FANOUT]) for k in range(0, len(row), FANOUT)])
    return levels[-1][0], proofs


def plain(rows):
    """The contract in plain Python: rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], []
    for s in order:
        made = sorted(((r[0] is not None, r[0] or 0, record((r[0], r[3], r[2], r[4], r[1])), r) for r in groups[s]), key=lambda x: x[:3])
        root, proofs = climb([m[2] for m in made])
        subs.append(root)
        inner.append(list(zip(made, proofs, strict=True)))
    root, tops = climb(subs)
    out = []
    for sub, rows_of, top in zip(subs, inner, tops, strict=True):
        for (_, _, leaf, r), proof in rows_of:
            path = proof + top
            digest = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
                digest = record((r[0], r[3], r[2], r[4], lower))
            for before, after in path:
                digest = h(*before, digest, *after)
            out.append((r[0], leaf, sub, root, h(*(x for b, a in path for x in b + a)), digest, digest == root))
    return out


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 4000, 4096, 40000, 65536])
def test_layout_has_each_place_once_and_the_root_first(levels, leaves):
    if leaves > FANOUT ** (levels - 1):
        return
    places = layout(levels, leaves)
    assert sorted(np.concatenate(places)) == list(range(node_count(levels, leaves)))
    assert places[-1].tolist() == [0]
    # Half of the levels lie together above each lower part, and each run of siblings lies together.
    lower = levels // 2
    if levels > 1:
        assert max(places[lower]) < min(places[lower - 1])
    for row in places[:-1]:
        for first in range(0, len(row), FANOUT):
            run = row[first:first + FANOUT]
            step = np.diff(run)
            assert (step == step[0]).all() if len(run) > 2 else True
    assert address(levels, leaves, 0, leaves - 1) == places[0][-1]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300, LEAVES])
def test_block_proofs_fold_to_its_root(n):
    leaves = [hashlib.sha256(bytes([k % 251, k // 251])).digest() for k in range(n)]
    block = Block(build_block(leaves, 0), n, 0)
    root, proofs = climb([x.hex() for x in leaves])
    assert block.node(block.levels - 1, 0).hex() == root and block.levels == levels_of(n, 0)
    for k, run, upper in block.paths():
        path = [*([run] if run else []), *upper]
        assert fold(leaves[k], path) == block.node(block.levels - 1, 0)
        assert [(r.before, r.after) for r in path] == [("".join(b).encode(), "".join(a).encode()) for b, a in proofs[k]]


def run_query(spark, rows, tmp_path, monkeypatch):
    import payloom.llm.queries as q

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "doc_id AS pos", "text AS block", "1 AS tree", "2 AS digest", "3 AS n", "4 AS above")
    monkeypatch.setattr(q, "table", lambda spark, sf, name: df)
    return sorted((tuple(r) for r in op12_merkle_manifest(spark, "").collect()), key=repr)


def test_query_equals_the_contract_with_nulls_ties_and_repeats(spark, tmp_path, monkeypatch):
    rows = [(k, f"Text {k} É" * (k % 7), ["en", None][k % 2], ["b", "a", None, "é"][k % 4], k) for k in range(300)]
    rows += [(1000 + k, "Hot " * 3, "en", "hot", None) for k in range(4200)]
    rows += [(None, "x", None, "b", 1), (None, "x", None, "b", 1), (None, None, "en", "b", 1), (5, None, "en", None, 2), (7, "A" * 300_000, "en", "lone", 300_000)]
    rows += [(7, "Again", "en", "a", 1), (7, "Again", "en", "a", 1), (20, "", "de", "", 0)]
    assert run_query(spark, rows, tmp_path, monkeypatch) == sorted(plain(rows), key=repr)


def test_exactly_one_full_block_and_many_trees(spark, tmp_path, monkeypatch):
    rows = [(k, "T", "en", "full", 1) for k in range(LEAVES)] + [(k, "S", "en", f"s{k}", 1) for k in range(LEAVES + 20)]
    assert run_query(spark, rows, tmp_path, monkeypatch) == sorted(plain(rows), key=repr)


def test_empty_table(spark, tmp_path, monkeypatch):
    assert run_query(spark, [], tmp_path, monkeypatch) == []


def test_paths_are_given_on_request(spark):
    df = spark.createDataFrame([(None, bytes([k]) * 32, k) for k in range(40)], "tree string, digest binary, id int")
    manifest = merkle_manifest(df, ["id"])
    for r in audit(manifest, proofs=True).collect():
        assert r["verified"] and fold(bytes.fromhex(r["leaf"]), unpacked(bytes(r["path"]))) == manifest.root and r["leaf"] == (bytes([r["id"]]) * 32).hex()
