"""Level by level through VARIANT data: each level's values are a written table, the next one is made from it.

A level costs one explode and one aggregate, whatever the depth of the data.
Nothing holds all levels of a row, and the driver gets only what is bounded.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.functions.variant import OBJECT, get, is_array, is_object

STEP = "\x1f"
ELEMENT, ANY_KEY = "[]", "{}"


@dataclass(frozen=True)
class KeyedRule:
    """When the keys of an object are data rather than field names.

    More than `most` different keys at one place, or at least `many` of which an
    object has on average no more than the given `share`. Counts of keys are sketches.
    """

    most: int = 1000
    many: int = 100
    share: float = 0.2

    def holds(self, n_keys: int, n_objects: int, n_entries: int) -> bool:
        return n_keys > self.most or n_keys >= self.many and n_entries <= self.share * n_keys * n_objects


def kept_level(df: DataFrame, name: str) -> DataFrame:
    """The rows as Parquet in a folder that driver and executors share: spark.checkpoint.dir, or the warehouse where it is unset."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/levels/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def opened(rows: DataFrame) -> DataFrame:
    """A row per field or element of the values ``v``: the other columns, pos, key (NULL for an element) and value.

    Each value comes with the names that it holds itself. Those of `variant_explode` keep the names of the
    whole value they were in, so the fields of an object by keys would be as large as the square of their number.
    """
    def entry(pos: Column, key: Column, value: Column) -> Column:
        return F.struct(pos.alias("pos"), key.alias("key"), value.alias("value"))

    fields = F.transform(F.map_entries(get("v", as_type=OBJECT)), lambda e, i: entry(i, e["key"], e["value"]))
    items = F.transform(get("v", as_type="array<variant>"), lambda x, i: entry(i, F.lit(None).cast("string"), x))
    return rows.select(*[c for c in rows.columns if c != "v"], F.inline(F.coalesce(fields, items)))


def kind_of(value: Column) -> Column:
    return F.when(F.is_variant_null(value), "null").when(is_array(value), "array").when(is_object(value), "object").otherwise("scalar")


def _step(key: Column) -> Column:
    """A path's next part; names that a path cannot hold plainly are quoted."""
    escaped = F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    plain = F.when(key.rlike(r"^[\p{L}_][\p{L}\p{N}_]*$"), F.concat(F.lit("."), key)).otherwise(F.concat(F.lit('["'), escaped, F.lit('"]')))
    return F.coalesce(plain, F.lit(ELEMENT))


def profile_paths(df: DataFrame, col: str, max_depth: int | None = None) -> DataFrame:
    """Every path of a payload column: ``(path, kind, n_rows, n_null)``.

    ``kind`` is object, array, scalar or null and a path of mixed shape has
    one row per kind, so ambiguous fields show up as data. List elements are
    folded into ``[]``; names that aren't plain words are quoted, as in ``$["a.b"]``.
    ``n_rows`` counts occurrences of the path in that kind, ``n_null`` its JSON
    nulls. All levels are opened, one job each; values that lie deeper than
    ``max_depth`` levels, if given, are an error.
    """
    level = df.filter(F.col(col).isNotNull()).select(F.lit("$").alias("path"), F.col(col).alias("v"))
    counts, depth = None, 0
    while True:
        kind = kind_of(F.col("v"))
        level = level.select("path", kind.alias("kind"), F.when(kind.isin("array", "object"), F.col("v")).alias("v"))
        if depth:
            level = kept_level(level, "paths")
            if level.isEmpty():
                return counts
            if max_depth is not None and depth > max_depth:
                raise ValueError(f"values below {level.first()['path']} lie deeper than {max_depth} levels")
        own = level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("kind") == "null").alias("n_null"))
        counts = own if counts is None else counts.unionAll(own)
        level = opened(level.filter("v IS NOT NULL").select("path", "v")).select(F.concat("path", _step(F.col("key"))).alias("path"), F.col("value").alias("v"))
        depth += 1


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """One type for two scalars of a field, by the rules of Spark's own variant schemas."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, T.LongType, T.DecimalType}:
        return T.DoubleType()
    if kinds <= {T.LongType, T.DecimalType}:
        x, y = (t if isinstance(t, T.DecimalType) else T.DecimalType(20, 0) for t in (a, b))
        whole, scale = max(x.precision - x.scale, y.precision - y.scale), max(x.scale, y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    return T.VariantType()


def infer_by_level(entities: DataFrame, rule: KeyedRule) -> dict[tuple[int, str], T.StructType]:
    """Types of entities (node, section, v), by node and section.

    Names count as they are written. An object whose keys are data becomes a
    MapType over the type of all its values, so neither the driver nor any type has
    more names than the rule allows. Fields are in order of their names.
    """
    found: dict[tuple, set[str]] = {}
    keyed: set[tuple] = set()
    place = ["node", "section", "path"]
    level = entities.select("node", "section", F.lit("").alias("path"), "v")
    roots = {(r["node"], r["section"]) for r in entities.select("node", "section").distinct().collect()}
    while True:
        value = F.col("value")
        shape = F.when(is_array(value), "ARRAY").when(is_object(value), "OBJECT").otherwise(F.schema_of_variant(value))
        entries = kept_level(opened(level).select(*place, "pos", "key", shape.alias("shape"), F.when(shape.isin("ARRAY", "OBJECT"), value).alias("v")), "types")
        sizes = entries.filter("key IS NOT NULL").groupBy(*place).agg(
            F.approx_count_distinct("key").alias("n_keys"), F.count_if(F.col("pos") == 0).alias("n_objects"), F.count(F.lit(1)).alias("n_entries")).collect()
        maps = {tuple(r[c] for c in place) for r in sizes if rule.holds(r["n_keys"], r["n_objects"], r["n_entries"])}
        keyed |= maps
        at = F.concat_ws("\x1e", *place)
        step = F.when(F.col("key").isNull(), F.lit(ELEMENT))
        if maps:
            step = step.when(at.isin(*sorted("\x1e".join(map(str, m)) for m in maps)), F.lit(ANY_KEY))
        entries = entries.withColumn("step", step.otherwise(F.concat(F.lit("."), "key")))
        shapes = entries.groupBy(*place, "step", "shape").agg(F.count(F.lit(1)).alias("n")).collect()
        for r in shapes:
            found.setdefault((r["node"], r["section"], r["path"], r["step"]), set()).add(r["shape"])
        if not any(r["shape"] in ("ARRAY", "OBJECT") for r in shapes):
            break
        level = entries.filter("v IS NOT NULL").select("node", "section", F.concat("path", F.lit(STEP), "step").alias("path"), "v")

    below: dict[tuple, list[str]] = {}
    for node, section, path, step in found:
        below.setdefault((node, section, path), []).append(step)

    def entity(node: int, section: str, path: str) -> T.DataType:
        if (node, section, path) in keyed:
            return T.MapType(T.StringType(), value_type(node, section, path, ANY_KEY))
        steps = sorted(s for s in below.get((node, section, path), ()) if s.startswith("."))
        return T.StructType([T.StructField(s[1:], value_type(node, section, path, s)) for s in steps])

    def value_type(node: int, section: str, path: str, step: str) -> T.DataType:
        shapes, here = found[(node, section, path, step)] - {"VOID"}, path + STEP + step
        if not shapes:
            return T.NullType()
        if shapes == {"OBJECT"}:
            return entity(node, section, here)
        if shapes == {"ARRAY"}:
            some = ELEMENT in below.get((node, section, here), ())
            return T.ArrayType(value_type(node, section, here, ELEMENT) if some else T.NullType())
        if shapes & {"OBJECT", "ARRAY"}:
            return T.VariantType()
        return reduce(_wider, [T.DataType.fromDDL(s) for s in sorted(shapes)])

    return {(node, section): entity(node, section, "") for node, section in roots}
