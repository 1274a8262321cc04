"""Token ids of whole documents in binary files of Simple-8b words, in document order.

A file holds the ids of its documents as one stream, cut into blocks of equal
numbers of ids that are coded on their own; then the word offsets of its
blocks, its document ids (with a null mark) and their numbers of tokens, and
a fixed footer. Any block can be decoded with numpy without those before it.

    magic | words of block 0 | words of block 1 | ... | offsets (u64, blocks + 1)
    | doc ids (i64) | nulls (u8) | token counts (u64) | footer: docs, ids, ids of a block, blocks (u64), magic
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm import simple8b
from payloom.llm.common import arrow_rows, batches_of, one_file_a_task, open_input, open_output, shared_folder, task_file, written
from payloom.llm.pieces import WordIds, memo_of

MAGIC = b"S8BTOK01"
FOOTER = struct.Struct("<4Q8s")
BLOCK_IDS = 1 << 16
FILE_IDS = 32 << 20
#: Texts that are encoded together, and rows that a task gets at a time (Spark ends a batch at 64 MB too).
GROUP_BYTES = 4 << 20
BATCH_ROWS = 2000
MANIFEST = pa.schema([("path", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


class FileWriter:
    def __init__(self, uri: str):
        self.uri, self.out = uri, open_output(uri)
        self.out.write(MAGIC)
        self.rest: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.offsets, self.docs, self.counts = [0], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK_IDS:
            stream = np.concatenate(self.rest)
            whole = len(stream) // BLOCK_IDS * BLOCK_IDS
            for k in range(0, whole, BLOCK_IDS):
                self._block(stream[k:k + BLOCK_IDS])
            self.rest, self.waiting = [stream[whole:]], len(stream) - whole

    def _block(self, ids: np.ndarray) -> None:
        words = simple8b.encode(ids)
        self.out.write(words.astype("<u8").tobytes())
        self.offsets.append(self.offsets[-1] + len(words))

    def close(self) -> tuple[int, int]:
        if self.waiting:
            self._block(np.concatenate(self.rest))
        for values, kind in ((self.offsets, "<u8"), ([d or 0 for d in self.docs], "<i8"), ([d is None for d in self.docs], "u1"), (self.counts, "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(FOOTER.pack(len(self.docs), self.n_ids, BLOCK_IDS, len(self.offsets) - 1, MAGIC))
        self.out.close()
        return len(self.docs), self.n_ids


def read_file(uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Documents of a file in order: (id, ids before it in the file, its ids); one block and one document in memory."""
    with open_input(uri) as source:
        size = source.size()
        n_docs, n_ids, block_ids, blocks, magic = FOOTER.unpack(source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        at = size - FOOTER.size - 17 * n_docs - 8 * (blocks + 1)
        table = source.read_at(size - FOOTER.size - at, at)
        offsets = np.frombuffer(table, "<u8", blocks + 1)
        docs = np.frombuffer(table, "<i8", n_docs, 8 * (blocks + 1)).tolist()
        nulls = np.frombuffer(table, "u1", n_docs, 8 * (blocks + 1) + 8 * n_docs).tolist()
        counts = np.frombuffer(table, "<u8", n_docs, 8 * (blocks + 1) + 9 * n_docs).tolist()
        held, block, done = np.zeros(0, "<u4"), 0, 0
        for doc, null, n in zip(docs, nulls, counts, strict=True):
            parts = [held]
            have = len(held)
            while have < n:
                a, z = int(offsets[block]), int(offsets[block + 1])
                words = np.frombuffer(source.read_at(8 * (z - a), len(MAGIC) + 8 * a), "<u8")
                ids = simple8b.decode(words, min(block_ids, n_ids - block * block_ids)).astype("<u4")
                parts.append(ids)
                have, block = have + len(ids), block + 1
            stream = np.concatenate(parts) if len(parts) > 1 else held
            yield (None if null else doc), done, stream[:n]
            held, done = stream[n:], done + n


def by_size(batch: pa.RecordBatch, limit: int = GROUP_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and bodies of consecutive rows whose bodies sum to about the limit."""
    ids, bodies, size = [], [], 0
    for doc, body in zip(*batch.columns, strict=True):
        ids.append(doc.as_py())
        bodies.append(body.as_py() or b"")
        size += len(bodies[-1])
        if size >= limit:
            yield ids, bodies
            ids, bodies, size = [], [], 0
    if ids:
        yield ids, bodies


def write_token_files(docs: DataFrame, tokenizer_file: str, *, separator: str = "<|endoftext|>", end_id: int = 2,
                      doc_id: str = "doc_id", text: str = "text", folder: str | None = None,
                      memo_bytes: int | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Write the files and return the list of them: (path, part, number, n_docs, n_ids), in document order.

    Rows are range-partitioned by id, the only shuffle, and sorted within
    partitions, so the files' order is the order of documents. Only files in
    the returned list count: an attempt that failed leaves others behind,
    which nothing reads.

    A null or empty text is just the end id. Null ids come first; rows with
    one id stand next to each other, in order of a hash of their texts. An empty
    table writes no file. Other columns are not read. A worker remembers the ids of
    words in two generations of ``memo_bytes`` (96 MB by default); with less, more words are encoded again.
    Texts are encoded together in groups of about ``group_bytes``.
    """
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"))
    ordered = rows.withColumn("tie", F.xxhash64("body")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo_of(WordIds, tokenizer_file, separator, "</w>", memo_bytes)
        end = np.array([end_id], "<u4")
        writer, listed = None, []

        def close() -> None:
            part = writer.uri.rsplit("/", 1)[1].split("-")
            listed.append((writer.uri, int(part[1]), int(part[2]), *writer.close()))

        for batch in batches:
            for ids, bodies in by_size(batch, group_bytes):
                for doc, raw in zip(ids, words.encode(bodies), strict=True):
                    if writer is None:
                        writer = FileWriter(task_file(folder, len(listed), ".s8b"))
                    writer.add(doc, np.concatenate([np.frombuffer(raw, "<u4"), end]))
                    if writer.n_ids >= FILE_IDS:
                        close()
                        writer = None
        if writer is not None:
            close()
        yield from batches_of(listed, MANIFEST)

    listed = ordered.select("doc_id", "body").mapInArrow(write, "path string, part int, number int, n_docs long, n_ids long")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return written(listed, "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Documents of the listed files: (doc_id, start, n_tokens, ids as little-endian unsigned 32-bit integers).

    `start` is the number of ids of all documents before it: a running sum
    over the list of files, of a row per file, and the place in the file.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from batches_of(((doc, before + at, len(ids), ids.tobytes()) for doc, at, ids in read_file(path)), ROWS)

    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("file_start"))
    return one_file_a_task(starts).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
