"""Naming and identifier helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two word-boundary patterns of the snake_case rule.
LOWER_TO_UPPER = r"([a-z0-9])([A-Z])"
ACRONYM_TO_WORD = r"([A-Z]+)([A-Z][a-z])"


def snake_case(name: str) -> str:
    """camelCase / PascalCase to snake_case; an acronym stays one word."""
    for boundary in (LOWER_TO_UPPER, ACRONYM_TO_WORD):
        name = re.sub(boundary, r"\1_\2", name)
    return name.lower()


def snake_case_column(col: Column | str) -> Column:
    """The same rule for names that arrive as data."""
    col = F.col(col) if isinstance(col, str) else col
    for boundary in (LOWER_TO_UPPER, ACRONYM_TO_WORD):
        col = F.regexp_replace(col, boundary, "$1_$2")
    return F.lower(col)


def split_table_name(name: str) -> tuple[str, str]:
    """``catalog.schema.table`` to ``(schema, table)``; schema is '' for a bare name."""
    *head, table = name.split(".")
    return (head[-1] if head else ""), table


def id_part(col: Column | str, index: int, sep: str = "_", at_least: int = 0) -> Column:
    """One part of a delimited id, NULL if the id is too short.

    A negative index counts from the end; ``at_least`` is the number of parts
    the id must have for the value to count.
    """
    col = F.col(col) if isinstance(col, str) else col
    parts = F.split(col, re.escape(sep))
    value = F.get(parts, F.lit(index)) if index >= 0 else F.try_element_at(parts, F.lit(index))
    return F.when(F.size(parts) >= at_least, value) if at_least else value


def audit_key(name: Column | str, *params: Column | str) -> Column:
    """``name[_competition][_season]``: empty parameters are left out."""
    as_col = [F.lit(p) if isinstance(p, str) else p for p in (name, *params)]
    return F.concat_ws("_", *[F.nullif(c, F.lit("")) for c in as_col])
