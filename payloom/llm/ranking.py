"""Positions and running fingerprints of rows within their key, however many rows a key has.

Rows are range-partitioned by key and order, so a key with a third of all rows
lies in many tasks. Each task numbers the rows of its own runs of equal keys;
what a run that began in an earlier task adds to them is worked out from one
row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.llm.common import written

#: Fingerprints are polynomials modulo this Mersenne prime.
MODULUS = (1 << 127) - 1
LOW = (1 << 64) - 1


def signed(value: int) -> int:
    """The low 64 bits as a signed number."""
    value &= LOW
    return value - (1 << 64) if value >> 63 else value


def split(value: int) -> tuple[int, int]:
    return value >> 64, signed(value)


def joined(high: int, low: int) -> int:
    return high << 64 | low & LOW


def element(high: int, low: int) -> int:
    """The fingerprint of one turn: 127 bits of its digest."""
    return ((high & LOW) << 64 | low & LOW) >> 1


def product(head: int, tail: int, tail_length: int, base: int) -> int:
    """Fingerprint of two sequences one after the other, from those of both and the length of the second."""
    return (head * pow(base, tail_length, MODULUS) + tail) % MODULUS


def ranked(df: DataFrame, key: str, order: list[str], name: str, digest: tuple[str, str] | None = None, base: int = 0) -> DataFrame:
    """The rows with ``pos``, their place among the rows of their key from 0 on; nulls come first.

    digest: two 64-bit columns whose values make a row's element. The result
    then has ``hi`` and ``lo`` too, the fingerprint of all elements up to the row.
    The driver gets one row per partition. Rows that are equal in key and order
    must be equal altogether for reruns to agree.
    """
    columns, scans = [F.col(c).asc_nulls_first() for c in (key, *order)], digest is not None
    arranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    added = [("pid", T.IntegerType(), pa.int32()), ("run", T.LongType(), pa.int64()), ("pos", T.LongType(), pa.int64())]
    added += [("hi", T.LongType(), pa.int64()), ("lo", T.LongType(), pa.int64())] if scans else []
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t, _ in added)])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, run, pos, now, state = TaskContext.get().partitionId(), -1, 0, None, 0
        for batch in batches:
            out: list[list[int]] = [[] for _ in added]
            digests = zip(batch.column(digest[0]).to_pylist(), batch.column(digest[1]).to_pylist(), strict=True) if scans else None
            for k in batch.column(key).to_pylist():
                if run < 0 or k != now:
                    run, pos, now, state = run + 1, 0, k, 0
                values = (pid, run, pos)
                if scans:
                    state = (state * base + element(*next(digests))) % MODULUS
                    values += split(state)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
                pos += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, (_, _, t) in zip(out, added, strict=True))],
                                             names=[*batch.schema.names, *(n for n, _, _ in added)])

    numbered = written(arranged.mapInArrow(number, schema), name)
    print_of = ["hi", "lo"] if scans else []
    edges = numbered.groupBy("pid").agg(
        F.max(F.struct("run", "pos", *print_of, F.col(key).alias("key"))).alias("last"),
        F.max(F.when(F.col("run") == 0, F.struct("pos", *print_of, F.col(key).alias("key")))).alias("first"))
    carried: dict[int, tuple[int, int]] = {}
    before = None
    for row in sorted(edges.collect(), key=lambda r: r["pid"]):
        first, last = row["first"], row["last"]
        count, state = before[1:] if before and before[0] == first["key"] else (0, 0)
        if count:
            carried[row["pid"]] = count, state
        if last["run"]:
            before = last["key"], last["pos"] + 1, joined(last["hi"], last["lo"]) if scans else 0
        else:
            own = joined(first["hi"], first["lo"]) if scans else 0
            before = first["key"], count + first["pos"] + 1, product(state, own, first["pos"] + 1, base) if scans else 0
    rest = numbered.filter("run > 0")

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n, _, _ in added}
            rows = [batch.column(at[n]).to_pylist() for n, _, _ in added]
            out: list[list[int]] = [[], [], []]
            for pid, _, pos, *own in zip(*rows, strict=True):
                count, state = carried.get(pid, (0, 0))
                values = (count + pos, *(split(product(state, joined(*own), pos + 1, base)) if count and scans else own))
                for column, value in zip(out, values):
                    column.append(value)
            columns = list(batch.columns)
            for n, values in zip(("pos", *print_of), out):
                columns[at[n]] = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    first = numbered.filter("run = 0")
    return rest.unionByName(first.mapInArrow(carry, schema) if carried else first).drop("pid", "run")
