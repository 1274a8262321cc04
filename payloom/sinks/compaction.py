"""The newest row per key of a table that grows by loads, kept in buckets so that each load touches only some of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.functions.variant import quote_name
from payloom.operators.keys import latest
from payloom.sinks.tables import LOAD, as_type, write_loads, write_table

BUCKET = "key_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quote_name(k)).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _load_of(bucket: int) -> str:
    """The load of the base, and so its partition, that holds a bucket."""
    return f"bucket {bucket:06d}"


def _names(target: str) -> tuple[str, str]:
    return f"{target}__base", f"{target}__compacted"


def _open_loads(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the loads that no compaction has seen, or that were loaded anew after one."""
    _, done = _names(target)
    rows = spark.table(target)
    if not spark.catalog.tableExists(done):
        return rows
    # One row per load on the right side, which Spark sends to all tasks if it is small.
    return rows.join(spark.table(done).select(F.col("load").alias("__load")), F.col(LOAD).eqNullSafe(F.col("__load")), "left_anti")


def _with_base(spark: SparkSession, target: str, rows: DataFrame, touched: Sequence[int] | None = None) -> DataFrame:
    """Rows and those of the base (in some buckets), in the types that the table has by now."""
    base, _ = _names(target)
    if not spark.catalog.tableExists(base):
        return rows
    stored = spark.table(base)
    stored = stored if touched is None else stored.filter(F.col(LOAD).isin(*map(_load_of, touched)))
    have = {f.name.lower(): f for f in stored.schema.fields}
    columns = [F.expr(as_type(have[f.name.lower()].name, have[f.name.lower()].dataType, f.dataType)) if f.name.lower() in have else F.lit(None).cast(f.dataType)
               for f in rows.schema.fields]
    return rows.unionAll(stored.select(*[c.alias(f.name) for c, f in zip(columns, rows.schema.fields, strict=True)]))


def latest_rows(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str] = ("ingested_at",), tiebreak: Sequence[str] = ("ingested_from",)) -> DataFrame:
    """The newest row per key: of the compacted base and the loads that came after it.

    Equals ``latest`` over all loads, whichever of them were compacted. Ties go as there.
    """
    return latest(_with_base(spark, target, _open_loads(spark, target).drop(LOAD)), tuple(keys), tuple(order), tuple(tiebreak))


def compact(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str] = ("ingested_at",), buckets: int = 256,
            tiebreak: Sequence[str] = ("ingested_from",)) -> int:
    """Fold the open loads of a table into its base; returns the number of buckets written.

    The base holds the newest row per key, in partitions by a hash of the key. Only buckets
    that open loads have rows for are read and written again, all swapped
    in one commit; the others stay as they are. The loads are noted as compacted
    last: a compaction that broke off is simply run again, as the newest of the newest
    rows is the same row. ``buckets``, ``order`` and the keys with their types must stay what they were at the first one.

    A load that is run again after it was compacted has to be opened again by ``reopen``.
    """
    base, done = _names(target)
    fresh = _open_loads(spark, target)
    # Bounded by the number of buckets and of open loads.
    touched = sorted(r[0] for r in fresh.select(_bucket(keys, buckets)).distinct().collect())
    loads = [r[0] for r in fresh.select(LOAD).distinct().collect()]
    if None in loads:
        raise ValueError(f"{target} has rows that belong to no load")
    if not loads:
        return 0
    newest = latest(_with_base(spark, target, fresh.drop(LOAD), touched), tuple(keys), tuple(order), tuple(tiebreak))
    placed = newest.withColumn(BUCKET, _bucket(keys, buckets)).repartition(BUCKET)
    write_loads(placed, base, F.format_string("bucket %06d", BUCKET), map(_load_of, touched))
    write_loads(spark.createDataFrame([(x,) for x in loads], "load string"), done, F.col("load"), loads)
    return len(touched)


def reopen(spark: SparkSession, target: str, load: str) -> None:
    """Let the next compaction read a load again that was loaded anew."""
    _, done = _names(target)
    if spark.catalog.tableExists(done):
        write_table(spark.createDataFrame([], "load string"), done, load=load)
