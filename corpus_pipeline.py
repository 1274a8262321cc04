"""Five stages from documents to token files, each on all that the one before it kept.

Every stage but the last returns the columns of documents, with its decisions
carried out. `run` writes what a stage returns to the shared folder as
Parquet and reads it back for the next one. SQL cannot express the language
models and sketches inside, so ORACLE_SQL is None; tests compare the rows
with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import fresh_name, written
from payloom.llm.decontamination import find_passages, hit_words
from payloom.llm.mixing import mix_sources
from payloom.llm.near_duplicates import near_duplicates
from payloom.llm.packaging import ship_package
from payloom.llm.quality import fit_ratios, judge_quality
from payloom.llm.token_files import read_token_files, write_token_files

ORACLE_SQL = None
#: Memo and texts at a time of the tokenizer's workers, which run beside a JVM that has grown over four stages.
STAGE_MEMO_BYTES, STAGE_GROUP_BYTES = 40 << 20, 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_package(spark)
    ratios = fit_ratios(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), language="lang", distinct=True)
    name = fresh_name(docs, "quality")
    return judge_quality(docs, ratios, name=name).filter(f"{name}.kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows that share an id are one document and stay or go together, rows without id stay.

    Shingles have two words, as in op2.
    """
    ship_package(spark)
    dropped = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    ship_package(spark)
    name = fresh_name(docs, "passages")
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=name)
    return found.filter(hit_words(name) == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows that share an id take the most copies of any of them."""
    ship_package(spark)
    taken = mix_sources(docs).filter("copies > 0").groupBy(F.col("doc_id").alias("taken_id")).agg(F.max("copies").alias("n"))
    taken = written(taken.select("taken_id", F.col("n").cast("int").alias("n")), "mix-copies")
    n, column = fresh_name(docs, "n"), fresh_name(docs, "taken_id")
    rows = docs.join(taken.toDF(column, n), docs["doc_id"].eqNullSafe(F.col(column)))
    return rows.withColumn(fresh_name(docs, "copy"), F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: (doc_id, start, n_tokens, ids_crc32)."""
    ship_package(spark)
    files = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), memo_bytes=STAGE_MEMO_BYTES, group_bytes=STAGE_GROUP_BYTES)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [("quality", quality), ("near_duplicates", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("token_files", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
