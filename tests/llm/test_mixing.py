import re
from fractions import Fraction

from payloom.llm.mixing import mix_sources


def targets(rows, share=Fraction(3, 2), weights=(3, 1, 2), most=2):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
        open_ -= over
    return sizes, target


def check(df, rows, miss):
    out = mix_sources(df).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in out) == sorted((r[0] is None, r[0]) for r in rows)
    sizes, target = targets(rows)
    taken, longest = {}, {}
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - float(target[r.source])) <= 1e-6 * max(1, float(target[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size and 0 <= r.rate <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= longest[s] + 1, (s, taken[s], t)
        assert abs(taken[s] - t) <= max(miss * float(t), longest[s] + 1)
    return sorted(map(tuple, out), key=repr)


def test_table_and_rerun(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    assert check(df, rows, 0.02) == check(df.repartition(7), rows, 0.02)


def test_edge_cases(docs):
    rows = [(i, "w " * (i % 9 + 1), "hot") for i in range(300)] + [(1000 + i, "same words here", "ties") for i in range(100)]
    rows += [(2000, None, "none"), (2001, "", "none"), (2002, "a b", None), (2003, "c", None), (None, "x y", "hot"), (None, "x y", "hot"), (5, "w", "hot"),
             (3000, "long " * 50000, "\U0001F600"), (3001, "é" * 5, "\uffff"), (3002, "a\u00a0b c", "z")]
    check(docs(rows), rows, 0.05)


def test_one_source_and_empty(docs):
    rows = [(i, "a b c", "only") for i in range(10)]
    check(docs(rows), rows, 1)
    assert mix_sources(docs([])).count() == 0
    empty = [(1, None, None), (2, "", "s")]
    check(docs(empty), empty, 1)
