"""Unpivots, pivots and id context: shape changes that need no shuffle (but the pivot)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.functions.text import id_part
from payloom.functions.variant import as_list, get, scalar_text


def _entries(df: DataFrame, col: str | Column, keep: Sequence[str]) -> DataFrame:
    """(kept columns, key, value) of every field of every object at ``col``."""
    col = F.col(col) if isinstance(col, str) else col
    objects = df.select(*keep, F.explode(as_list(col)).alias("__object"))
    fields = df.sparkSession.tvf.variant_explode(F.col("__object").outer())
    return objects.lateralJoin(fields).select(
        *keep, F.col("key").alias("__key"), F.col("value").alias("__value")).filter(F.col("__key").isNotNull())


def unpivot_numbered(df: DataFrame, col: str, prefix: str, value_path: tuple[str, ...] = (),
                     number: str = "number", value: str = "value") -> DataFrame:
    """Numbered keys ``prefix1..prefixN`` as rows ``(number, value)``; missing values give no row.

    All rows are read, so no key range has to be known or sampled beforehand.
    A suffix beyond the range of BIGINT gives a row whose number is NULL.
    """
    keep = [c for c in df.columns if c != col]
    pattern = f"^{re.escape(prefix)}([0-9]+)$"
    rows = _entries(df, col, keep).filter(F.col("__key").rlike(pattern))
    return rows.select(
        *keep,
        F.regexp_extract("__key", pattern, 1).try_cast("bigint").alias(number),
        get("__value", *value_path, as_type="string").alias(value),
    ).filter(F.col(value).isNotNull())


def max_number(df: DataFrame, col: str, prefix: str, out: str = "max_number") -> DataFrame:
    """Largest numeric suffix of the keys with a prefix over all rows; 0 if there is none."""
    pattern = f"^{re.escape(prefix)}([0-9]+)$"
    keys = _entries(df, col, []).filter(F.col("__key").rlike(pattern))
    return keys.agg(F.coalesce(F.max(F.regexp_extract("__key", pattern, 1).try_cast("bigint")), F.lit(0).cast("bigint")).alias(out))


def unpivot_named(df: DataFrame, col: str, objects: Mapping[str, Sequence[str]], kind: str,
                  fields: Mapping[str, str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Named sub-objects as rows with a type column; absent and empty ones give no row.

    ``objects`` maps the label to the path, ``fields`` the output column to the field.
    """
    types = types or {}
    keep = [c for c in df.columns if c != col]
    places = F.array(*[
        F.struct(F.lit(label).alias("kind"), get(col, *path).alias("node")) for label, path in objects.items()])
    rows = df.select(*keep, F.inline(places))
    rows = rows.filter(F.coalesce(F.size(F.map_keys(get("node", as_type="map<string,variant>"))) > 0, F.lit(False)))
    return rows.select(
        *keep, F.col("kind").alias(kind),
        *[get("node", f, as_type=types.get(c, "string")).alias(c) for c, f in fields.items()])


def unpivot_lists(df: DataFrame, col: str, lists: Mapping[int | str, Sequence[str]], kind: str,
                  element: str) -> DataFrame:
    """Several typed lists of one payload as one set of rows with a period column.

    ``element`` is the struct type of an entry; it is read in one typed cast
    per list, and the output has the kept columns, ``kind`` and ``entry``.
    """
    keep = [c for c in df.columns if c != col]
    places = F.array(*[
        F.struct(F.lit(label).alias("kind"), as_list(col, *path, element=element).alias("items"))
        for label, path in lists.items()])
    rows = df.select(*keep, F.inline(places))
    return rows.select(*keep, F.col("kind").alias(kind), F.explode("items").alias("entry")).filter(
        F.col("entry").isNotNull())


def long_attributes(df: DataFrame, col: str, keys: Sequence[str], attr: str = "attr", value: str = "value") -> DataFrame:
    """Dynamic scalar attributes in long form: one row per (entity, attribute)."""
    return _entries(df, col, list(keys)).select(
        *keys, F.col("__key").alias(attr), scalar_text("__value").alias(value)).filter(F.col(value).isNotNull())


def wide_attributes(df: DataFrame, keys: Sequence[str], names: Sequence[str], attr: str = "attr",
                    value: str = "value") -> DataFrame:
    """Long attributes back to one column per listed name (a given list: no job to find it)."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(attr) == n, F.col(value))).alias(n) for n in names])


def text_columns(df: DataFrame) -> DataFrame:
    """The all-text form of a table; VARIANT and nested values become JSON text."""
    def to_text(f) -> Column:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if f.dataType.typeName() in ("array", "struct", "map"):
            return F.to_json(c)
        return c.cast("string")

    return df.select(*[to_text(f).alias(f.name) for f in df.schema.fields])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union with the ordered union of all columns, missing ones NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def context_from_id(df: DataFrame, col: str, parts: Mapping[str, int], sep: str = "_", at_least: int = 0) -> DataFrame:
    """Columns parsed from a delimited id; NULL where the id is too short."""
    return df.withColumns({name: id_part(col, i, sep, at_least) for name, i in parts.items()})
