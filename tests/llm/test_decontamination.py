import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payloom.llm import decontamination
from payloom.llm.decontamination import Matcher, find_passages, hit_words, words_of


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        size = min(window, len(b))
        wins = {tuple(b[k:k + size]) for k in range(len(b) - size + 1)} if size else set()
        for k in range(len(w) - size + 1):
            if tuple(w[k:k + size]) in wins:
                hit.update(range(k, k + size))
                found.add(str(item) if item is not None else None)
    return len(w), len(hit), sorted(found - {None})


word = st.sampled_from(["a", "b", "ab", "é", "7"])
sentence = st.lists(word, max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(sentence, st.lists(sentence, min_size=1, max_size=5), st.integers(1, 4))
def test_search_equals_brute_force(text, bodies, window):
    items = [(str(k), b.encode()) for k, b in enumerate(bodies)]
    found = set()
    spans = Matcher(items, window).find(words_of(text.encode()), [], found)
    assert (len(words(text)), sum(z - a for a, z in spans), sorted(found)) == brute(text, enumerate(bodies), window)


def results(df, bench):
    out = find_passages(df, bench)
    name = next(c for c in out.columns if c.endswith("passages") and c not in df.columns)
    return {(r[0], r[1]): tuple(r[2:]) for r in out.select("doc_id", "text", f"{name}.n_words", hit_words(name), f"{name}.items").collect()}


@pytest.mark.parametrize("block_bytes", [1 << 22, 60])
def test_edge_cases(spark, docs, monkeypatch, block_bytes):
    """Also with a benchmark that takes many blocks."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    passage = "One two, THREE four five six seven eight nine ten eleven twelve"
    items = [(1, passage), (2, "short item"), (3, None), (4, ""), (5, "..."), (None, "zeta eta"), (2, "short item"), (10, "short"), (11, passage)]
    rows = [(1, None), (2, ""), (3, passage.upper()), (4, "x " + passage + " y " + passage), (5, "a Short-item here"), (6, "zeta  eta zeta eta"),
            (7, "one two three four five six seven eight nine"), (8, "w " * 200000 + passage), (None, "short"), (3, passage.upper()), (9, "shorts items")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("passages", F.lit(0))
    assert results(docs(rows), bench) == {r: brute(r[1], items) for r in rows}


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert results(docs([(1, "a b")]), bench) == {(1, "a b"): (2, 0, [])}
    assert results(docs([]), bench) == {}
