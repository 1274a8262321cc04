import re
from collections import Counter

import numpy as np
import pytest

from payloom.llm.quality import fit_ratios, judge_quality


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {p for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for p in range(k, k + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n)


def judged(df, ratios, **options):
    out = judge_quality(df, ratios, **options)
    name = next(c for c in out.columns if c.endswith("quality") and c not in df.columns)
    return [(r[0], r[1], tuple(r[2])) for r in out.select("doc_id", "text", name).collect()]


def gram_counts(texts, n=3, bits=16):
    out = np.zeros(1 << bits, np.int64)
    for t in texts:
        raw = (t or "").encode()
        for k in range(len(raw) - n + 1):
            h = 0
            for c in raw[k:k + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ c
            out[(h * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)] += 1
    return out


def test_table_against_brute_force(spark, sf):
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    rows = df.collect()
    raw, target = gram_counts(r.text for r in rows), gram_counts(r.text for r in rows if r.doc_id in trusted)
    ratios = fit_ratios(df, labels)
    assert np.allclose(ratios.log_ratio, np.log(target + 1) - np.log(raw * target.sum() / raw.sum() + 1))
    for _, text, got in judged(df, ratios):
        assert got[:6] == base(text)
        assert got[7] == (not got[5] and got[6] >= -0.3)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_labelled_documents_part(spark, size):
    sf = f"/root/testdata/sf{size}"
    df, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = {d: q[7] for d, _, q in judged(df, fit_ratios(df, labels)) if not q[5]}
    good = [kept[r.doc_id] for r in labels.collect() if r.quality == 1 and r.doc_id in kept]
    bad = [kept[r.doc_id] for r in labels.collect() if r.quality == 0 and r.doc_id in kept]
    assert all(good) and not any(bad)


def test_bounded_sample_of_labels(spark, sf):
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    few, again = (fit_ratios(df, labels, max_trusted=20).log_ratio for _ in range(2))
    assert (few == again).all() and few.any() and (few != fit_ratios(df, labels).log_ratio).any()


def test_edge_cases(spark, docs):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\n "), (4, "ab"), (5, words), (5, words), (None, words + "\n" + words), (6, "x " * 100000), (7, "é\u00a0ü " * 60),
            (8, "a\nb\na\n \na\r\na"), (9, "#*$%&|<> # é"), (10, "a b c a b c a b"), (11, words + " tail " * 3)]
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 1, 0), (6, 0, None), (77, 1, None)], "doc_id long, quality int, toxic int")
    ratios = fit_ratios(docs(rows), labels)
    found = judged(docs(rows), ratios)
    assert len(found) == len(rows)
    for _, text, got in found:
        assert got[:6] == base(text), text
    assert judged(docs([]), fit_ratios(docs([]), labels)) == []
    nothing = fit_ratios(docs(rows), labels.limit(0))
    assert not nothing.log_ratio.any()


@pytest.fixture(scope="module")
def labelled(spark):
    sf = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang"), spark.read.parquet(f"{sf}/labels.parquet")


def test_copies_of_a_clean_text_stay(spark, labelled):
    """A third of the rows are copies of one text, unlabelled; it is judged as without them."""
    df, labels = labelled
    options = {"language": "lang", "distinct": True}
    alone = fit_ratios(df, labels, **options)
    longest = [r for r in judge_quality(df, alone).filter("quality.kept AND quality.score >= -0.1").orderBy("quality.n_words", "doc_id").collect()][::150]
    for r in longest:
        copies = spark.range(10**6, 10**6 + 500).selectExpr("id AS doc_id").crossJoin(spark.createDataFrame([(r.text, r.lang)], "text string, lang string"))
        ratios = fit_ratios(df.union(copies), labels, **options)
        assert np.allclose(ratios.log_ratio, alone.log_ratio)
        assert all(q[7] for _, _, q in judged(copies, ratios))


@pytest.mark.parametrize("lang", ["en", "de", "fr", "es"])
def test_language_without_trusted_texts(labelled, lang):
    """Its clean texts stay, and junk that other languages show too goes."""
    df, labels = labelled
    known = df.filter(f"lang <> '{lang}'").select("doc_id")
    kept = {d: q[7] for d, _, q in judged(df, fit_ratios(df, labels.join(known, "doc_id", "left_semi"), language="lang", distinct=True)) if not q[5]}
    own = {r.doc_id: r.quality for r in labels.join(df.filter(f"lang = '{lang}'"), "doc_id", "left_semi").collect() if r.doc_id in kept}
    assert all(kept[d] for d in own if own[d])
    assert not any(kept[d] for d in own if not own[d])
