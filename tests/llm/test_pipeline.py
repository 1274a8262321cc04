import zlib

import numpy as np
import public_tokenizers
from compare import compare, oracle
from tokenizers import Tokenizer

import corpus_pipeline
from payloom.llm.queries import ORACLES, QUERIES


def test_oracles(spark, sf):
    con = oracle(sf)
    for name in ("op1_warc", "op5_decontamination"):
        assert compare(spark, con, sf, name, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_against_brute_force(spark, sf):
    """Each stage on its own input; decisions by the brute-force versions of the operators' tests."""
    from test_decontamination import brute as passages
    from test_near_duplicates import brute as groups
    from test_quality import base

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (docs, out := corpus_pipeline.written(stage(spark, docs, sf), name))
        docs = out
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()
        assert after.join(before, before.columns, "left_anti").count() == 0
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    texts = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]
    before, after = seen["quality"]
    failed = {d for d, t in texts(before) if base(t)[5]}
    assert not failed & set(ids(after)) and len(ids(after)) > 0.7 * (len(ids(before)) - len(failed))
    before, after = seen["near_duplicates"]
    assert ids(after) == sorted(g[0] for g in groups(texts(before)) if g[3])
    before, after = seen["decontamination"]
    assert ids(after) == sorted(d for d, t in texts(before) if not passages(t, items)[1])
    before, after = seen["mixing"]
    words = {d: len(t.split()) for d, t in texts(before)}
    assert abs(sum(words[d] for d in ids(after)) - 1.5 * sum(words.values())) < 0.05 * sum(words.values())
    before, after = seen["token_files"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((d, len(x := [*t.encode(b).ids, 2]), zlib.crc32(np.array(x, "<u4").tobytes())) for d, b in texts(before))
    rows = after.orderBy("start").collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist() and [r.doc_id for r in rows] == ids(before)


def test_run_on_a_table_with_nulls_and_clashing_columns(spark, docs, tmp_path, sf):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"start{i} {words} end{i}", f"s{i % 3}") for i in range(30)] + [(None, words + " q", None), (40, None), (41, ""), (42, words), (42, words)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "not in there at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs([]).write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{t}.parquet")).limit(0).write.parquet(str(tmp_path / "empty" / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
