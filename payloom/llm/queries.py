"""The dealt queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import ascii_lower
from payloom.llm.decontamination import find_passages, hit_words
from payloom.llm.hidden_markov import score_texts
from payloom.llm.language_codes import crc_remainder, fit_codebook, identify
from payloom.llm.licences import KNOWN, canonical_sql, known_licences, scan_licences
from payloom.llm.merkle import audit, merkle_manifest, record_digest
from payloom.llm.mixing import mix_sources
from payloom.llm.near_duplicates import near_duplicates
from payloom.llm.packaging import ship_package
from payloom.llm.prefix_trie import prefix_trie
from payloom.llm.quality import fit_ratios, judge_quality
from payloom.llm.token_counts import count_tokens
from payloom.llm.token_files import read_token_files, write_token_files
from payloom.llm.url_templates import UrlRule, judge_urls
from payloom.llm.warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
URL_RULES = [UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/")]


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _base32_sql(hex_digits: str) -> str:
    """Base32 of a 160-bit hexadecimal text: each five bits lie in two neighbouring hexadecimal digits."""
    def digit(k: int) -> str:
        at, shift = 5 * k // 4, 3 - 5 * k % 4
        value = [f"(strpos('0123456789abcdef', substr({hex_digits}, {at + p}, 1)) - 1)" for p in (1, 2)]
        return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((16 * {value[0]} + {value[1]}) >> {shift}) & 31), 1)"

    return " || ".join(map(digit, range(32)))


@query("op1_warc", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, max(page_id) AS last FROM p GROUP BY hex)
SELECT p.page_id, p.payload_bytes, {_base32_sql("p.hex")} AS payload_digest,
  CASE WHEN p.page_id = g.last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN p.page_id <> g.last THEN g.last END AS refers_to
FROM p JOIN g USING (hex)""")
def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = read_warc(write_warc(table(spark, sf, "pages")), payloads=False)
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_near_duplicates")
def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    files = write_token_files(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op5_decontamination", """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, win.item_id, places.i, places.k FROM places JOIN win USING (k, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = find_passages(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    n_hit = hit_words("passages")
    return found.select("doc_id", "passages.n_words", n_hit.alias("n_hit"), F.size("passages.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("passages.items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op7_quality")
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return judge_quality(docs, fit_ratios(docs, table(spark, sf, "labels"), language="lang", distinct=True)).select("doc_id", "quality.*")


@query("op8_url_templates")
def op8_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(table(spark, sf, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template")


@query("op9_hidden_markov")
def op9_hidden_markov(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(table(spark, sf, "documents"))


_KNOWN_SQL = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)


@query("op10_licences", f"""
WITH k AS (SELECT sha256({canonical_sql("t")}) AS digest, min(licence) AS licence FROM (VALUES {_KNOWN_SQL}) v(licence, t) GROUP BY 1),
d AS (SELECT doc_id, {canonical_sql("text")} AS form FROM documents),
r AS (SELECT doc_id, (CASE WHEN form = '' THEN 0 ELSE length(form) - length(replace(form, ' ', '')) + 1 END)::BIGINT AS n_words, sha256(form) AS digest FROM d)
SELECT doc_id, n_words, r.digest AS canonical_sha256, CASE WHEN n_words > 0 THEN licence END AS licence FROM r LEFT JOIN k ON r.digest = k.digest""")
def op10_licences(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licences(table(spark, sf, "documents"), known_licences(spark))


@query("op11_language_codes")
def op11_language_codes(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    remainder = crc_remainder(F.col("doc_id"), 3)
    found = identify(docs.drop("lang"), fit_codebook(docs.filter(remainder != 1)))
    return found.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        "language.score", "language.bit_errors", "language.ambiguous")


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: bit by bit, from the all-ones register."""
    step = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"


def _merkle_sql() -> str:
    """Levels one after the other; unrolled for the test tables, up to 16^5 documents of a source and 16^3 sources.

    A level of a tree with one node left repeats it and adds no siblings.
    """
    def field(x: str) -> str:
        return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS claimed FROM documents)",
             "n0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM leaves)",
             "p0 AS (SELECT doc_id, source, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, '' AS proof, claimed AS f FROM leaves)"]

    def level(k: int, tree: str, n: str, p: str, kept: str) -> None:
        steps.extend([
            f"r{n}{k} AS (SELECT {tree}, i // 16 AS g, list(h ORDER BY i) AS run, max(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS c FROM {n}{k}) GROUP BY 1, 2)",
            f"{n}{k + 1} AS (SELECT {tree}, g AS i, CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM r{n}{k})",
            f"{p}{k + 1} AS (SELECT {kept}, i // 16 AS i, proof || CASE WHEN c = 1 THEN '' ELSE array_to_string(run[:i % 16], '') || array_to_string(run[i % 16 + 2:], '') END AS proof, "
            f"CASE WHEN c = 1 THEN f ELSE sha256(array_to_string(run[:i % 16], '') || f || array_to_string(run[i % 16 + 2:], '')) END AS f "
            f"FROM {p}{k} JOIN r{n}{k} ON {p}{k}.{tree} IS NOT DISTINCT FROM r{n}{k}.{tree} AND i // 16 = g)"])

    for k in range(5):
        level(k, "source", "n", "p", "doc_id, p{0}.source AS source, leaf".format(k))
    steps += ["s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM n5)",
              "m0 AS (SELECT 0 AS t, i, subroot AS h FROM s)",
              "q0 AS (SELECT doc_id, leaf, subroot, 0 AS t, s.i AS i, proof, f FROM p5 JOIN s ON p5.source IS NOT DISTINCT FROM s.source)"]
    for k in range(3):
        level(k, "t", "m", "q", "doc_id, leaf, subroot, q{0}.t AS t".format(k))
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, m3.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = m3.h AS verified FROM q3, m3"


@query("op12_merkle_manifest", _merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    d = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    changed = record_digest(*(d | {"text": ascii_lower(d["text"])}).values())
    leaves = table(spark, sf, "documents").select(
        d["source"].alias("tree"), record_digest(*d.values()).alias("digest"), "doc_id", F.when(crc_remainder(d["doc_id"], 5) == 0, changed).alias("claimed"))
    return audit(merkle_manifest(leaves, ["doc_id"]), claimed="claimed").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_prefix_trie", f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT DISTINCT conv_id, {_crc32_sql("conv_id::VARCHAR")} % 4 AS h FROM conversations),
b AS (SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND i <= h UNION ALL SELECT c.conv_id, i + 10000, role, text FROM c JOIN t USING (conv_id) WHERE i > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth, list(role || chr(30) || text) OVER (PARTITION BY conv_id ORDER BY i) AS path,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, count(*) OVER (PARTITION BY conv_id) AS n FROM b
  UNION ALL SELECT conv_id, 0, []::VARCHAR[], 0, (SELECT count(*) FROM b WHERE b.conv_id = c.conv_id) FROM c),
k AS (SELECT conv_id, depth, sha256(array_to_string(path, chr(31))) || depth AS node, words, depth = n AS ended FROM r),
g AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM k GROUP BY node, depth),
e AS (SELECT g.node, up.node AS parent FROM g JOIN k up ON up.conv_id = g.conv_id AND up.depth = g.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM e GROUP BY 1),
sub AS (SELECT k.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum(saved) AS saved_tokens FROM g JOIN k ON k.conv_id = g.conv_id AND k.depth <= g.depth LEFT JOIN kids ON kids.node = g.node GROUP BY 1)
SELECT g.conv_id, g.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, g.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, g.ends_sha256
FROM g LEFT JOIN e USING (node) LEFT JOIN g p ON p.node = e.parent LEFT JOIN kids ON kids.node = g.node JOIN sub ON sub.node = g.node""")
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    conv = F.col("conv_id")
    trie = prefix_trie(table(spark, sf, "conversations"), head=crc_remainder(conv, 4), source=conv - conv % 20, longest=3)
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
