"""One row per key: latest, first, distinct, merged. All pre-reduce before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK = "__rank"


def row_hash(df: DataFrame, skip: Sequence[str]) -> Column:
    """Last resort for ties that does not depend on row order: a hash of the row."""
    cols = []
    for f in df.schema.fields:
        if f.name not in skip:
            plain = not isinstance(f.dataType, (T.VariantType, T.MapType))
            cols.append(F.col(quote(f.name)) if plain else F.col(quote(f.name)).cast("string"))
    return F.xxhash64(*cols) if cols else F.lit(0)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _require(df: DataFrame, keys: Sequence[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not among {df.columns}")


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # `rank == 1` over row_number lets Spark keep one row per key and task
    # before the exchange (WindowGroupLimit), so a hot key does not travel.
    window = Window.partitionBy(*[F.col(quote(k)) for k in keys]).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("ingested_at",),
           tiebreak: Sequence[str | Column] = ("ingested_from",)) -> DataFrame:
    """Newest row per key. Ties fall to ``tiebreak`` and then to the row's hash."""
    _require(df, keys)
    cols = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    ties = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tiebreak
            if not isinstance(c, str) or c in df.columns]
    return _pick(df, keys, [*cols, *ties, row_hash(df, keys)])


def first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("ingested_at", "ingested_from")) -> DataFrame:
    """Earliest row per key."""
    _require(df, keys)
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    return _pick(df, keys, [*cols, row_hash(df, keys)])


def distinct_on(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct full rows, or one deterministic row per key subset."""
    if not keys:
        return df.distinct()
    _require(df, keys)
    return _pick(df, keys, [F.col(quote(c)).asc_nulls_last() for c in df.columns
                            if c not in keys and not isinstance(df.schema[c].dataType, (T.VariantType, T.MapType))]
                 or [F.lit(0)])


def merge_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("ingested_at", "ingested_from"),
               columns: Sequence[str] | None = None) -> DataFrame:
    """One record per key out of several rows; per column the last non-null value wins."""
    _require(df, keys)
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    rest = columns if columns is not None else [c for c in df.columns if c not in keys]
    # The value itself ends the order, so equal ranks still give one answer.
    picked = [
        F.max_by(F.col(quote(c)), F.when(F.col(quote(c)).isNotNull(), F.struct(rank, F.col(quote(c))))).alias(c)
        for c in rest
    ]
    return df.groupBy(*[F.col(quote(k)) for k in keys]).agg(*picked)


def max_per_key(df: DataFrame, keys: Sequence[str], col: str, out: str = "high_water",
                count: str | None = None) -> DataFrame:
    """High-water mark (and row count) per key."""
    aggs = [F.max(col).alias(out)]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
