import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from payloom.llm import simple8b
from payloom.llm.pieces import PieceLengths, WordIds
from payloom.llm.token_counts import count_tokens
from payloom.llm.token_files import read_token_files, write_token_files

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "a  b", "<|endoftext|>x foo<|endoftext|>bar", "<|startoftext|>", "\u0301a b", "x y\u3000z", "don't can 't", "a\nb\n\nc \n d", "é b", "\x1c a\x1fb",
       "<|ENDOFTEXT|> A. <|endoftext|>.", "é. é, e\u0301. ×. ÷! ñ?! ß; foo.’ it's. A.B.", "\x85 x\u00a0 y", "\u00a0\u00a0z", "123 4567", "Ǆ İ ΑΣ", "a\r\nb\tc\x0bd", "😀😀 🤝", "\x00 \x00"]
text = st.text(alphabet=st.sampled_from(list("ab Z'\n\t é\u00a0\u2003.,19<|>\u0301😀")) | st.characters(codec="utf-8"), max_size=60)


@pytest.fixture(scope="module")
def words():
    return WordIds(WORDS, "<|endoftext|>")


@pytest.fixture(scope="module")
def lengths():
    return PieceLengths(BYTES, 16)


@settings(max_examples=300, deadline=None)
@given(st.lists(text | st.sampled_from(ODD), max_size=5))
def test_pieces_equal_whole_texts(words, lengths, texts):
    raw = [t.encode() for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(raw)] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.count(raw) == [len(lengths.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_pieces_on_the_table_with_a_full_memo(spark, sf, monkeypatch):
    monkeypatch.setattr("payloom.llm.pieces.MEMO_BYTES", 500 * 180)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    raw = [t.encode() for t in texts]
    w, n = WordIds(WORDS, "<|endoftext|>"), PieceLengths(BYTES, 4096)
    for k in range(0, len(raw), 40):
        assert [np.frombuffer(x, "<u4").tolist() for x in w.encode(raw[k:k + 40])] == [e.ids for e in w.tokenizer.encode_batch(texts[k:k + 40], add_special_tokens=False)]
        assert n.count(raw[k:k + 40]) == [len(e.ids) for e in n.tokenizer.encode_batch(texts[k:k + 40], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 3) | st.integers(0, 60000) | st.sampled_from([2 ** 60 - 1, 2 ** 60, (15 << 60) | (2 ** 60 - 1)]), max_size=400),
       st.integers(0, 500))
def test_simple8b_round_trip(values, zeros):
    a = np.array([0] * zeros + values, np.uint64)
    assert simple8b.decode(simple8b.encode(a), len(a)).tolist() == a.tolist()


def test_simple8b_packs():
    assert len(simple8b.encode(np.zeros(240, np.uint64))) == 1
    assert len(simple8b.encode(np.full(60, 1, np.uint64))) == 1
    assert len(simple8b.encode(np.full(7, 200, np.uint64))) == 1


def brute(rows):
    t = Tokenizer.from_file(WORDS)
    out, start = [], 0
    for doc, body in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(body or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def files_of(df):
    return [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in read_token_files(write_token_files(df, WORDS)).orderBy("start").collect()]


def test_token_files(spark, sf, docs, monkeypatch):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert files_of(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (-3, "first"), (50, "long words " * 60000), (51, None), (52, "")]
    assert files_of(docs(rows)) == brute(rows)
    assert files_of(docs([])) == []
    tied = files_of(docs([(1, "a"), (1, "b c"), (1, "a"), (0, "z")]))
    assert [r[0] for r in tied] == [0, 1, 1, 1] and sorted(r[2] for r in tied) == [2, 2, 2, 3]


def test_blocks_and_files_roll_over(tmp_path):
    from payloom.llm import token_files

    old = token_files.BLOCK_IDS
    token_files.BLOCK_IDS = 100
    try:
        w = token_files.FileWriter(str(tmp_path / "a.s8b"))
        r = np.random.RandomState(0)
        parts = [r.randint(0, 49408, n).astype("<u4") for n in (1, 99, 100, 101, 350, 1, 7)]
        for k, p in enumerate(parts):
            w.add(k if k != 3 else None, p)
        assert w.close() == (7, sum(map(len, parts)))
        back = list(token_files.read_file(str(tmp_path / "a.s8b")))
    finally:
        token_files.BLOCK_IDS = old
    assert [b[0] for b in back] == [0, 1, 2, None, 4, 5, 6]
    assert [b[2].tolist() for b in back] == [p.tolist() for p in parts]
    assert [b[1] for b in back] == np.cumsum([0, *map(len, parts)])[:-1].tolist()


def test_counts(spark, sf, docs):
    t = Tokenizer.from_file(BYTES)
    rows = [(i, x) for i, x in enumerate(ODD)] + [(None, None), (7, "a"), (7, "a"), (99, "no-cut" * 300000), (98, "many words é " * 200000)]
    want = sorted(((d, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 1024) for d, x in rows), key=repr)
    assert sorted(map(tuple, count_tokens(docs(rows), BYTES).collect()), key=repr) == want
    assert count_tokens(docs([]), BYTES).count() == 0
    df = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) for r in df.collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, BYTES).collect()} == want


def test_memo_is_bounded_by_bytes_and_forgets_long_pieces():
    from payloom.llm.pieces import LONGEST, Memo

    memo = Memo()

    def learn(pieces):
        memo.current.update((p, p * 2) for p in pieces)

    long = b"x" * 100_000
    assert memo.values([[b"a", long, b"a"], [long]], learn) == [[b"aa", long * 2, b"aa"], [long * 2]]
    assert set(memo.current) == {b"a"} and memo.bytes < 1000
    for k in range(300):
        memo.values([[b"%d %d " % (k, j) * 20 for j in range(2000)]], learn)
    held = sum(len(k) + len(v) for part in (memo.current, memo.previous) for k, v in part.items())
    assert all(len(p) <= LONGEST for p in memo.current) and held < 140 << 20


def test_one_thing_is_kept_in_a_worker():
    from payloom.llm.common import kept_one

    made = []
    for key in (("a",), ("a",), ("b",), ("a",)):
        kept_one(key, lambda key=key: made.append(key) or key)
    assert made == [("a",), ("b",), ("a",)]


def test_a_smaller_memo_and_group_hold_less_and_give_the_same_files(spark, tmp_path):
    from payloom.llm.pieces import Memo
    from payloom.llm.token_files import read_token_files, write_token_files

    memo = Memo(1 << 20)
    for k in range(40):
        memo.values([[b"%d %d" % (k, j) for j in range(2000)]], lambda pieces: memo.current.update((p, p) for p in pieces))
    assert len(memo.current) + len(memo.previous) < 30_000 < 40 * 2000
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 977}x" for j in range(300))) for i in range(60)], "doc_id long, text string")
    small = read_token_files(write_token_files(docs, WORDS, folder=str(tmp_path / "small"), memo_bytes=2000, group_bytes=1500))
    whole = read_token_files(write_token_files(docs, WORDS, folder=str(tmp_path / "whole")))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, whole.collect()))
