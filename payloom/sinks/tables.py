"""Writing tables: lineage columns, appends that widen, loads that can be repeated, row counts without a second job."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.functions.text import split_table_name
from payloom.functions.variant import quote_name

LINEAGE = ("source_schema", "source_table_name", "target_schema", "target_table_name")
LOAD = "load_key"
# Properties of a view: the store that it shows, and whether the store has loads.
STORE, LOADS = "payloom.store", "payloom.loads"
WRITERS = 4
# Integral types from the narrowest, with the digits that hold any value.
_INTEGRAL = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def stamp_lineage(df: DataFrame, source: str, target: str) -> DataFrame:
    """Four constant columns that say where a row came from and where it was written."""
    values = (*(split_table_name(source) if source else ("", "")), *split_table_name(target))
    return df.withColumns({c: F.lit(v) for c, v in zip(LINEAGE, values)})


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both without loss; text where there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (type(a), type(b))
    if all(k in _INTEGRAL for k in kinds):
        return a if _INTEGRAL[kinds[0]] > _INTEGRAL[kinds[1]] else b
    exact = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_INTEGRAL.get(type(t)), 0) for t in (a, b)]
    if all(whole is not None for whole, _ in exact):
        whole, scale = max(w for w, _ in exact), max(s for _, s in exact)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if all(k in (T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType) for k in kinds):
        return T.DoubleType()
    if set(kinds) == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _tag(dtype: T.DataType) -> str:
    plain = re.sub(r"\W+", "_", dtype.simpleString()).strip("_")
    return plain if isinstance(dtype, T.AtomicType) else f"{type(dtype).__name__.lower()}_{hashlib.sha1(dtype.simpleString().encode()).hexdigest()[:8]}"


def as_type(name: str, given: T.DataType, to: T.DataType) -> str:
    """SQL that reads a column as a wider type. Text is what the payload said: decimals without the zeros that their column added."""
    value = quote_name(name)
    if given == to:
        return value
    if isinstance(to, T.StringType):
        if isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
            return f"to_json({value})"
        if isinstance(given, T.DecimalType) and given.scale:
            return f"trim(TRAILING '.' FROM trim(TRAILING '0' FROM CAST({value} AS string)))"
    return f"CAST({value} AS {to.simpleString()})"


def _table(name: str) -> str:
    return ".".join(map(quote_name, name.split(".")))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _location(spark: SparkSession, store: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_table(store)}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def _create(spark: SparkSession, store: str, fields: Iterable[T.StructField], parts: Iterable[str]) -> None:
    """An empty store. Files that a lost driver left where it belongs don't count: only partitions that a store has are read."""
    columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in fields)
    ddl = f"CREATE TABLE {_table(store)} ({columns}) USING parquet", f"PARTITIONED BY ({', '.join(map(quote_name, parts))})"
    try:
        spark.sql(" ".join(ddl))
    except PySparkException as e:
        if e.getCondition() != "LOCATION_ALREADY_EXISTS":
            raise
        *database, name = store.split(".")
        folder = spark.catalog.getDatabase(*database or [spark.catalog.currentDatabase()]).locationUri
        spark.sql(f"{ddl[0]} {ddl[1]} LOCATION {_literal(f'{folder}/{name.lower()}')}")


def _places(spark: SparkSession, store: str) -> dict[str, list[T.StructField]]:
    """The columns of a store in which each column of its view lies, one for each type that loads have brought."""
    out: dict[str, list[T.StructField]] = {}
    for f in spark.table(store).schema.fields:
        name, mark, tag = f.name.rpartition("~")
        out.setdefault((name if mark and tag == _tag(f.dataType) else f.name).lower(), []).append(f)
    return out


def _show(spark: SparkSession, target: str, store: str, loads: bool) -> None:
    """Let the view show a store: each column with the narrowest type that holds what all loads brought."""
    columns = []
    for name, fields in _places(spark, store).items():
        if name != LOAD or loads:
            to = reduce(wider, [f.dataType for f in fields])
            parts = [as_type(f.name, f.dataType, to) for f in fields]
            columns.append(f"{parts[0] if len(parts) == 1 else f'coalesce({', '.join(parts)})'} AS {quote_name(fields[0].name)}")
    wanted = f"SELECT {', '.join(columns)} FROM {_table(store)}"
    spark.sql(f"CREATE OR REPLACE VIEW {_table(target)} TBLPROPERTIES ('{STORE}' = {_literal(store)}, '{LOADS}' = '{int(loads)}') AS {wanted}")


def _shown(spark: SparkSession, target: str) -> tuple[str | None, bool]:
    """The store that a view shows, and whether it has loads. A plain table is copied into a store first."""
    if _is_table(spark, target):
        store = f"{target}__a"
        _drop(spark, store)
        old = spark.table(target)
        _create(spark, store, [*old.schema.fields, T.StructField(LOAD, T.StringType())], [*_partitions(spark, target), LOAD])
        old.withColumn(LOAD, F.lit("")).write.insertInto(store)
        spark.sql(f"DROP TABLE {_table(target)}")
        _show(spark, target, store, False)
    if spark.catalog.tableExists(target):
        found = dict(tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {_table(target)}").collect())
        if STORE not in found:
            raise ValueError(f"{target} is a view of its own")
        return found[STORE], found[LOADS] == "1"
    # The first write was lost before the view was there.
    return (f"{target}__a", False) if _is_table(spark, f"{target}__a") else (None, False)


def _drop(spark: SparkSession, store: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_table(store)}")


def _fit(spark: SparkSession, df: DataFrame, store: str) -> DataFrame:
    """Rows in the columns of a store, which gets a column more for each type that none of its own holds without loss.

    No stored row is ever written again, and no value is cast to a narrower type.
    """
    places, columns, new = _places(spark, store), [], []
    for f in df.schema.fields:
        own = places.get(f.name.lower(), [])
        fitting = [p for p in own if p.dataType == f.dataType] or [p for p in own if wider(p.dataType, f.dataType) == p.dataType]
        if fitting:
            at = fitting[0]
        else:
            at = T.StructField(f"{own[0].name}~{_tag(f.dataType)}" if own else f.name, f.dataType)
            new.append(at)
        columns.append(F.expr(as_type(f.name, f.dataType, at.dataType)).alias(at.name))
    if new:
        spark.sql(f"ALTER TABLE {_table(store)} ADD COLUMNS ({', '.join(f'{quote_name(f.name)} {f.dataType.simpleString()}' for f in new)})")
    return df.select(*columns)


def _in_order(spark: SparkSession, df: DataFrame, store: str) -> DataFrame:
    given = {c.lower() for c in df.columns}
    return df.select(*[F.col(quote_name(f.name)) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(store).schema.fields])


def _written(df: DataFrame, target: str, write) -> int:
    seen = Observation(f"rows of {target}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write)
    return int(seen.get.get("rows") or 0)


def _write_load(df: DataFrame, target: str, store: str, parts: list[str], load: str, supersedes: str | None) -> int:
    """Swap the load's partition for the new rows in one commit, whatever an earlier attempt left there."""
    spark, name, own = df.sparkSession, _table(store), f"{LOAD} = {_literal(load)}"
    if len(parts) > 1:  # rows of an earlier attempt may lie in partitions that this one doesn't write
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({own})")
    n = _written(df, target, lambda w: w.format("parquet").mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(_location(spark, store)))
    if len(parts) > 1:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({own})" if n else f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({own})")
    if supersedes is not None:
        for (partition,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
            other = unquote(partition.rsplit(f"{LOAD}=", 1)[1])
            if other.startswith(supersedes) and other != load:
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({LOAD} = {_literal(other)})")
    spark.catalog.refreshTable(store)
    return n


def write_table(df: DataFrame, target: str, mode: str = "append", source: str = "", partition_by: Iterable[str] = (),
                load: str | None = None, supersedes: str | None = None) -> int:
    """Write one table and return its row count, observed while it is written.

    ``load`` names what is being loaded, e.g. a run's key and the start of its
    window. Its rows are a partition of their own, swapped in one commit: running
    a load again, wherever a lost driver ended the last attempt, gives the rows of one
    run. ``supersedes``: loads whose names begin so are dropped once this one is
    in place, as a full load holds all of their rows.

    ``target`` is a view over a store of Parquet files. A column that later loads
    bring with a wider type gets one more column in the store, and the view shows both
    in the type that holds all values; no row is written twice. ``overwrite``
    fills a second store, to which the view is turned when it is complete. A
    table without rows is still created, so readers find its schema.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"tables are appended to or overwritten, not {mode!r}")
    spark, parts = df.sparkSession, [*partition_by, LOAD]
    loads = load is not None and mode == "append"
    current, loaded = _shown(spark, target)
    stamped = stamp_lineage(df, source, target)
    known = _places(spark, current) if current and mode == "append" else {}
    # A column of nothing but NULLs is text until rows tell better; a table that knows it is left as it is.
    void = [f.name for f in stamped.schema.fields if isinstance(f.dataType, T.NullType) and f.name.lower() not in known]
    stamped = stamped.withColumns({c: F.col(quote_name(c)).cast("string") for c in void}) if void else stamped
    stamped = stamped.withColumn(LOAD, F.lit(load if loads else ""))
    if mode == "overwrite" or current is None:
        store = f"{target}__b" if current == f"{target}__a" else f"{target}__a"
        _drop(spark, store)
        _create(spark, store, stamped.schema.fields, parts)
        if mode == "append":
            _show(spark, target, store, loads)
            loaded = loads
    else:
        store = current
        parts = _partitions(spark, store)
    fitted = _fit(spark, stamped, store)
    if loads:
        n = _write_load(fitted, target, store, parts, load, supersedes)
    else:
        n = _written(_in_order(spark, fitted, store), target, lambda w: w.mode(mode).insertInto(store))
    if mode == "overwrite":
        _show(spark, target, store, False)
        if current:
            _drop(spark, current)
    elif known or loads != loaded:
        _show(spark, target, store, loads or loaded)
    return n


def write_loads(df: DataFrame, target: str, load: Column, names: Iterable[str]) -> None:
    """Write several loads at once, each row in the one that ``load`` names, and swap them all in one commit.

    ``names`` are the loads that get rows.
    """
    spark = df.sparkSession
    write_table(df.limit(0), target, load=f"{target} schema")
    store, _ = _shown(spark, target)
    fitted = _fit(spark, df.withColumn(LOAD, load), store)
    fitted.write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).save(_location(spark, store))
    for name in names:
        spark.sql(f"ALTER TABLE {_table(store)} ADD IF NOT EXISTS PARTITION ({LOAD} = {_literal(name)})")
    spark.catalog.refreshTable(store)


def write_all(tables: Mapping[str, DataFrame], source: str = "", mode: str = "append", load: str | None = None,
              supersedes: str | None = None) -> dict[str, int]:
    """Write every table of a fan-out, a few at a time; keys are full table names.

    All tables are tried; then the first failure is raised.
    """
    with ThreadPoolExecutor(WRITERS) as pool:
        running = {t: pool.submit(write_table, df, t, mode, source, (), load, supersedes) for t, df in tables.items()}
    return {t: r.result() for t, r in running.items()}


def drop_tables(spark: SparkSession, targets: Iterable[str]) -> None:
    """Reset: drop the given output tables, with their stores, if they exist."""
    for target in targets:
        if spark.catalog.tableExists(target):
            spark.sql(f"DROP {'TABLE' if _is_table(spark, target) else 'VIEW'} {_table(target)}")
        for store in (f"{target}__a", f"{target}__b"):
            _drop(spark, store)
