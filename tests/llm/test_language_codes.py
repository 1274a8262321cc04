import random

import numpy as np
import pytest

import payloom.llm.queries as q
from payloom.llm.language_codes import ORDERS, WINDOW, Codebook, codewords, decode, fit_codebook, grams, identify, margins

SOUNDS = {"aa": "ba lo mi ra", "bb": "sch ung keit ver", "cc": "eau oi tion ment", "dd": "ingly the and ness", "ee": "ци то на про"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SOUNDS[lang].split(), k=rng.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 31, 255, 300])
def test_codewords_differ_and_no_bit_is_idle(n):
    words = codewords([f"l{k}" for k in range(n)])
    assert len({w.tobytes() for w in words}) == n or n == 1
    assert all(len(set(column)) == 2 for column in words.T)
    if 3 < n <= 255:
        # Half of a Hadamard row's places differ; columns left out are repeats only below eight languages.
        distance = min((a != b).sum() for i, a in enumerate(words) for b in words[:i])
        assert distance >= words.shape[1] // 2 - 1


def test_windows_lose_no_gram():
    rng = random.Random(5)
    text = prose(rng, "bb", 30_000).encode()
    assert len(text) > 2 * WINDOW
    body = b" " + b" ".join(text.lower().split()) + b" "
    assert sum(map(len, grams(text))) == sum(len(body) - n + 1 for n in ORDERS)


def test_decoding_corrects_wrong_bits_and_weighs_them():
    words = codewords(list("abcdefgh"))
    book = Codebook(list("abcdefgh"), words, np.zeros((1, words.shape[1]), np.float32), np.full(words.shape, 1 / words.shape[1]))
    for i, word in enumerate(words):
        margin = 5.0 * word
        assert decode(margin, book)[0] == book.languages[i] and not decode(margin, book)[3]
        margin[1] *= -1
        lang, score, errors, ambiguous = decode(margin, book)
        assert (lang, errors, ambiguous) == (book.languages[i], 1, False) and 0 <= score <= 1
    assert decode(np.zeros(words.shape[1]), book)[3]
    # A bit that is worth nothing to any language can't change the answer.
    worth = book.worth.copy()
    worth[:, :4] = 0
    blind = book._replace(worth=worth)
    other = 5.0 * words[2]
    other[:4] *= -1
    assert decode(other, blind)[0] == decode(5.0 * words[2], blind)[0]


def plain_book(rows):
    """Counts, weights and worth with no Spark."""
    langs = sorted({lang for _, lang in rows})
    size = 1 << 16
    counts = {x: np.zeros(size) for x in langs}
    for text, lang in rows:
        for found in grams(text.encode()):
            counts[lang] += np.bincount(found, minlength=size)
    words = codewords(langs)
    shares = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * size) for x in langs])
    weights = np.stack([np.log(shares[w > 0].mean(0) / shares[w < 0].mean(0)) for w in words.T], 1)
    right = np.zeros(words.shape)
    for text, lang in rows:
        i = langs.index(lang)
        right[i] += words[i] * margins(text.encode(), weights.astype(np.float32)) > 0
    return Codebook(langs, words, weights, right / right.sum(1, keepdims=True))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(9)
    return [(prose(rng, lang, rng.choice([2, 10, 100])), lang) for lang in SOUNDS for _ in range(1 + 20 * (lang != "aa"))]


def test_fitted_book_equals_plain_counts(spark, labelled):
    df = spark.createDataFrame([(t, x, 1) for t, x in labelled], "text string, lang string, bucket int").repartition(5)
    book, own = fit_codebook(df), plain_book(labelled)
    assert book.languages == own.languages and (book.words == own.words).all()
    assert np.allclose(book.weights, own.weights, atol=1e-4) and np.allclose(book.worth, own.worth)


def test_odd_rows(spark, labelled):
    extra = [(None, "aa"), ("", "bb"), ("123 456 !?", "cc"), ("ba lo mi", None), ("bala bami " * 40_000, "aa")]
    df = spark.createDataFrame([(t, x, 1) for t, x in labelled + extra], "text string, lang string, language int")
    book = fit_codebook(df)
    found = identify(df, book)
    assert found.columns == ["text", "lang", "language", "_language"]
    rows = found.collect()
    for r in rows:
        got = r["_language"]
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert tuple(got) == ("und", 0.0, 0, True)
        else:
            assert got["lang"] == (r["lang"] or "aa") and 0 <= got["score"] <= 1
    # A text in unknown signs gets some language, and is marked.
    assert identify(spark.createDataFrame([("漢字",)], "text string"), book).first()["language"]["ambiguous"]


def test_nothing_learned_or_one_language(spark):
    texts = spark.createDataFrame([("abc",), (None,), ("1",)], "text string")
    none = fit_codebook(spark.createDataFrame([], "text string, lang string"))
    assert {r["language"]["lang"] for r in identify(texts, none).collect()} == {"und"}
    one = fit_codebook(spark.createDataFrame([("abc", "xx")], "text string, lang string"))
    assert [r["language"]["lang"] for r in identify(texts, one).collect()] == ["xx", "und", "und"]
    assert identify(texts.limit(0), one).collect() == []


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = q.op11_language_codes(spark, sf).collect()
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert len(rows) == len(truth) and len(held) > 200
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
