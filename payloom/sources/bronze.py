"""Reading bronze: scope by source id, half-open load window, elements."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_COLUMNS = ("ingested_from", "ingested_at", "l0payload", "l1element", "payload")


def scope_params(scope: str) -> tuple[str, ...]:
    """Placeholders of a scope template, in order."""
    return tuple(name for _, name, _, _ in string.Formatter().parse(scope) if name)


def scope_filter(scope: str, params: Mapping[str, str], exact: bool = False, col: str = "ingested_from") -> Column | None:
    """Rows of one competition / season; None for a template without parameters, or where none is given at all.

    Some, but not all, of the parameters are an error: a scope with a gap
    would take in rows of other competitions or seasons.

    Text is compared literally and whole id parts at a time: scope ``x_11``
    takes ``x_11`` and ``x_11_2024`` but not ``x_111``. Equality and prefix
    tests on the plain id column are pushed down to the scan.
    """
    needed = scope_params(scope)
    missing = [n for n in needed if not params.get(n)]
    if len(missing) == len(needed):
        return None
    if missing:
        raise ValueError(f"scope {scope!r} lacks {', '.join(missing)}")
    wanted = scope.format(**params)
    same = F.col(col) == wanted
    return same if exact else same | F.col(col).startswith(wanted + "_")


def window_filter(low: datetime | str | None, high: datetime | str | None, col: str = "ingested_at") -> Column | None:
    """Half-open window ``low < ts <= high``; a missing bound is open."""
    bounds = []
    if low is not None:
        bounds.append(F.col(col) > F.lit(low).cast("timestamp"))
    if high is not None:
        bounds.append(F.col(col) <= F.lit(high).cast("timestamp"))
    return all_of(*bounds)


def all_of(*conditions: Column | None) -> Column | None:
    given = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, given) if given else None


def select_element(df: DataFrame, *elements: str) -> DataFrame:
    col = F.col("l1element")
    return df.filter(col == elements[0] if len(elements) == 1 else col.isin(*elements))


def read_bronze(spark: SparkSession, source: str, *conditions: Column | None) -> DataFrame:
    """A bronze table, or a Parquet folder if ``source`` is a path, under all given conditions."""
    if "/" in source:
        df = spark.read.parquet(source)
    else:
        if not spark.catalog.tableExists(source):
            raise ValueError(f"source table {source!r} does not exist")
        df = spark.read.table(source)
    cond = all_of(*conditions)
    return df if cond is None else df.filter(cond)


def stage(df: DataFrame, name: str, by: Sequence[str] = ("l1element",)) -> DataFrame:
    """The rows of one run as Parquet, partitioned by ``by`` (one partition per element), in the shared checkpoint folder.

    Every table of a run reads the rows it needs again. Staged, the source is
    scanned once and each table reads only the elements it is made of; the
    result also survives the loss of an executor.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("staging needs spark.checkpoint.dir, a folder all executors can reach")
    path = f"{base.rstrip('/')}/staged/{name}"
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
