"""Shared folders, tables that cut lineage, and files written by tasks."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The one thing that a worker process keeps for its tasks, by what it is made from.
_KEPT: dict[tuple, object] = {}

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors reach.

    Without that setting only a local session may go on: driver and executors
    are then one process and share the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/payloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, no lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let checkpoint() write to the folder of spark.checkpoint.dir."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_result(df: DataFrame, text: str, compute, name: str) -> DataFrame:
    """The frame with all its columns, and what an Arrow function makes of the text's bytes.

    Marked as nondeterministic so that a filter on the result doesn't run it twice.
    """
    return df.withColumn(name, compute.asNondeterministic()(F.col(f"`{text}`").cast("binary")))


def kept_one(key: tuple, make):
    """What `make` gives, made once in a worker process and kept until something else is asked for.

    A worker lives longer than a stage; what earlier stages needed doesn't stay beside this one's.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Record batches of at most so many rows for queries that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def task_file(folder: str, number: int, suffix: str) -> str:
    """A file name of its own for each attempt, so that a repeated task never touches a file that is in use."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():05d}-{number:04d}-{task.taskAttemptId()}{suffix}"


def open_output(uri: str):
    files, path = pafs.FileSystem.from_uri(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return files.open_output_stream(path, compression=None)


def open_input(uri: str):
    files, path = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def one_file_a_task(manifest: DataFrame) -> DataFrame:
    """The rows of a list of files, dealt out one by one."""
    parallel = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(max(parallel, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def batches_of(rows, schema: pa.Schema, limit: int = 4 << 20):
    """Record batches of rows (tuples) of about `limit` bytes of binary and text values each."""
    columns: list[list] = [[] for _ in schema]
    size = 0
    for row in rows:
        for column, value in zip(columns, row, strict=True):
            column.append(value)
            size += len(value) if isinstance(value, (bytes, str)) else 8
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            columns, size = [[] for _ in schema], 0
    if columns and columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
