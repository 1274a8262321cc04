"""Registry and builders for bronze rows out of relational rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.plans.catalog import pipeline
from payloom.plans.tables import pipeline_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Choices of a template that are made outside of it; each doubles the expressions of a payload.
CHOICES = 1


class Either:
    """One of two shapes, chosen per row by an SQL condition."""

    def __init__(self, condition: str, then, otherwise):
        self.condition, self.then, self.otherwise = condition, then, otherwise


class Repeat:
    """A list of ``n`` (SQL) entries; the template may use the entry number ``i``, from 1."""

    def __init__(self, n: str, entry: dict):
        self.n, self.entry = n, entry


def _kind(t):
    """What a template becomes without VARIANT: text, a struct, a uniform list, or None if it cannot."""
    if isinstance(t, str):
        return "text"
    if isinstance(t, dict) and t:
        return tuple((k, _kind(v)) for k, v in t.items())
    if isinstance(t, list) and t and isinstance(t[0], dict):
        kinds = {_kind(x) for x in t}
        return ("list", kinds.pop()) if len(kinds) == 1 and None not in kinds else None
    return None


def _native(t) -> str:
    """Template to SQL: text is SQL already, dicts are structs, lists of one shape arrays, the rest is VARIANT."""
    if isinstance(t, str):
        return t
    if isinstance(t, list) and _kind(t):
        return f"array({', '.join(map(_native, t))})"
    if isinstance(t, dict) and t:
        return "named_struct(" + ", ".join(f"'{k}', {_native(v)}" for k, v in t.items()) + ")"
    return variant_sql(t)


def _conditions(t) -> list[str]:
    """Conditions of all choices inside a template, one for each place; those in a ``Repeat`` may use its entry number."""
    if isinstance(t, Either):
        return [t.condition, *_conditions(t.then), *_conditions(t.otherwise)]
    return [c for x in (t.values() if isinstance(t, dict) else t if isinstance(t, list) else ()) for c in _conditions(x)]


def _given(t, condition: str, holds: bool):
    """The template where the condition holds or does not (or is NULL)."""
    if isinstance(t, Either):
        if t.condition == condition:
            return _given(t.then if holds else t.otherwise, condition, holds)
        return Either(t.condition, _given(t.then, condition, holds), _given(t.otherwise, condition, holds))
    if isinstance(t, dict):
        return {k: _given(v, condition, holds) for k, v in t.items()}
    return [_given(x, condition, holds) for x in t] if isinstance(t, list) else t


def chosen_first(t, most: int = CHOICES):
    """The same template with its most frequent choices made outside of it.

    What is chosen inside is a VARIANT of its own, which is built and then copied into the whole; chosen
    outside, the whole is built once.
    """
    t = _given(t, "false", False)
    if isinstance(t, Either):
        return Either(t.condition, chosen_first(_given(t.then, t.condition, True), most), chosen_first(_given(t.otherwise, t.condition, False), most))
    found = _conditions(t)
    if not found or not most:
        return t
    first = max(dict.fromkeys(found), key=found.count)
    return Either(first, *(chosen_first(_given(t, first, holds), most - 1) for holds in (True, False)))


def variant_sql(t) -> str:
    """Template to an SQL expression of type VARIANT; entries of a list may differ in shape."""
    if t is None:
        return "parse_json('null')"
    if isinstance(t, Either):
        return f"CASE WHEN {t.condition} THEN {variant_sql(t.then)} ELSE {variant_sql(t.otherwise)} END"
    if isinstance(t, Repeat):
        n = f"CAST({t.n} AS int)"
        some = f"transform(sequence(1, greatest({n}, 1)), i -> {variant_sql(t.entry)})"
        return f"to_variant_object(slice({some}, 1, greatest({n}, 0)))"
    if isinstance(t, list) and _kind(t):
        return f"to_variant_object({_native(t)})"
    if isinstance(t, list):
        return f"to_variant_object(array({', '.join(map(variant_sql, t))}))" if t else "parse_json('[]')"
    if isinstance(t, dict):
        return f"to_variant_object({_native(t)})" if t else "parse_json('{}')"
    return f"CAST({t} AS variant)"


def variant(t) -> Column:
    return F.expr(variant_sql(t))


def bronze_rows(df: DataFrame, source_id: str, at: str, sections: dict, l0=None) -> DataFrame:
    """One bronze row per table row and section.

    ``sections`` maps the element name to (condition, payload template).
    """
    # Each section is a projection of its own, so a filter on the element leaves out the sections that
    # it does not ask for before any row is read, and the code of each is generated alone.
    l0payload = variant(chosen_first(l0)) if l0 is not None else F.lit(None).cast("variant")
    parts = [
        (df if cond == "true" else df.filter(cond)).select(
            F.expr(source_id).alias("ingested_from"), F.expr(at).cast("timestamp").alias("ingested_at"),
            l0payload.alias("l0payload"), F.lit(name).alias("l1element"), variant(chosen_first(t)).alias("payload"))
        for name, (cond, t) in sections.items()]
    return reduce(DataFrame.unionAll, parts)


def reloaded(make):
    """The same feed, in which some sources were delivered a day earlier as well: keys have to pick the newer load."""
    def both(spark: SparkSession, sf: str) -> DataFrame:
        df = make(spark, sf)
        older = df.filter("crc32(ingested_from) % 3 = 0").withColumn("ingested_at", F.expr("ingested_at - INTERVAL 1 DAY"))
        return df.unionByName(older)

    return both


def text(expr: str) -> str:
    return f"CAST({expr} AS string)"


def plain_time(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps without zone, as the test tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols or ("ingested_at",)})


def domain_query(name: str, bronze: Callable[[SparkSession, str], DataFrame], pipe: str, suffix: str, sql: str,
                 columns: tuple[str, ...] = ()):
    """Register one output table of a domain pipeline, in full or by some columns."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = pipeline_tables(pipeline(pipe), bronze(spark, sf), only=(suffix,))[suffix]
        df = df.select(*columns) if columns else df
        return df.withColumns({
            f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})

    query(name, sql)(run)
