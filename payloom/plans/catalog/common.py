"""Small shorthands shared by the pipeline specs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.operators.keys import merge_rows
from payloom.plans.spec import ALL, Field, Node

SOURCE_SCHEMA = "bronze_stats"
TARGET_SCHEMA = "bronze_stats_flatten"


def source(table: str) -> str:
    return f"{SOURCE_SCHEMA}.{table}"


def target(prefix: str) -> str:
    return f"{TARGET_SCHEMA}.{prefix}"


def named(**columns: str) -> tuple[Field, ...]:
    """``named(team_id="TeamID")``: an explicit rename map, all text."""
    return tuple(Field(json, column) for column, json in columns.items())


def id_columns(start: int, *names: str, last: str | None = None) -> dict[str, tuple[int, int]]:
    """Columns from consecutive id parts; ``last`` is the final part of an id that has more parts."""
    out = {n: (start + i, 0) for i, n in enumerate(names)}
    if last:
        out[last] = (-1, start + len(names))
    return out


def part(table: str, *path: str, require: str | None = "filled", fields=ALL, list_key: str | None = None,
         **more) -> Node:
    """A child table with every scalar of the objects at a path."""
    return Node(table=table, path=path, fields=fields, require=require, list_key=list_key, **more)


def children(table: str, *path: str, fields=ALL, **more) -> Node:
    return Node(table=table, path=path, fields=fields, **more)


def merge_into(out: str, parts: tuple[str, ...], keys: tuple[str, ...]):
    """One record per key from several part tables; later parts and later loads win per column."""

    def post(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        rest = {k: v for k, v in tables.items() if k not in parts}
        union = None
        for i, p in enumerate(parts):
            df = tables[p].withColumn("__part", F.lit(i))
            union = df if union is None else union.unionByName(df, allowMissingColumns=True)
        columns = [c for c in union.columns if c not in (*keys, "__part")]
        merged = merge_rows(union, keys, ("__part", "ingested_at", "ingested_from"), columns)
        rest[out] = merged.drop(*[k for k in keys if k.startswith("__")])
        return rest

    return post
