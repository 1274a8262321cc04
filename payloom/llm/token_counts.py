"""Token counts of whole texts, lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.pieces import PieceLengths, memo_of

WINDOW_BYTES = 1 << 20


def length_function(tokenizer_file: str, window: int = WINDOW_BYTES):
    @F.arrow_udf("bigint")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = memo_of(PieceLengths, tokenizer_file, window)
        for batch in batches:
            yield pa.array(counter.count([t or b"" for t in batch.to_pylist()]), pa.int64())

    return n_tokens


def count_tokens(docs: DataFrame, tokenizer_file: str, *, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: (id, n_bytes, n_tokens, over_limit).

    An Arrow function gets the texts of a batch, groups them by bytes (1 MB),
    cuts longer texts at safe boundaries, encodes the distinct pieces of a
    group in batches of equal bytes and returns nothing but lengths. The file
    has to be one of byte-level BPE with the usual word pattern and without
    prefix blanks. Special strings in a text count as the library counts them.

    A null or empty text has 0 bytes and 0 tokens. A text without a safe
    boundary is encoded in one piece. Repeated rows and null ids give a row
    each, an empty table gives none; other columns are not looked at.
    """
    rows = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("binary").alias("body"))
    counter = length_function(tokenizer_file).asNondeterministic()  # else a filter on the count would run it again
    counted = rows.select(rows[0].alias(doc_id), F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("n_bytes"),
                          counter("body").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
