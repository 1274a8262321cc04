"""Column helpers over VARIANT: quoted paths, tolerant reads and list coercion.

Everything here returns a lazy ``Column`` made of built-in expressions, with
literal paths, so Catalyst sees exactly which parts of a payload are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def vpath(*keys: str | int) -> str:
    """Quoted VARIANT path, safe for dots, blanks and quotes in field names."""
    out = "$"
    for key in keys:
        if isinstance(key, int):
            out += f"[{key}]"
        elif '"' not in key:
            out += f'["{key}"]'
        elif "'" not in key:
            out += f"['{key}']"
        else:
            raise ValueError(f"field name mixes both quote styles: {key!r}")
    return out


def get(value: Column | str, *keys: str | int, as_type: str = "variant") -> Column:
    """Typed read at a path; NULL when the path is missing or the cast fails."""
    return F.try_variant_get(_col(value), vpath(*keys), as_type)


def present(value: Column | str) -> Column:
    """Neither SQL NULL nor JSON null."""
    value = _col(value)
    return value.isNotNull() & ~F.is_variant_null(value)


def is_array(value: Column | str) -> Column:
    return get(value, as_type="array<variant>").isNotNull()


def is_object(value: Column | str) -> Column:
    # Any object casts to a struct, whatever its fields; nothing else does.
    return get(value, as_type="struct<__none:variant>").isNotNull()


def non_empty_object(value: Column | str) -> Column:
    return F.coalesce(F.size(F.map_keys(get(value, as_type=OBJECT))) > 0, F.lit(False))


def as_list(value: Column | str, *keys: str | int, element: str = "variant") -> Column:
    """The value at a path as an array, whether it holds a list or one entity.

    XML converters turn a one-element list into a bare object. An array stays
    an array (an empty one stays empty), anything else becomes a list of one;
    elements that do not fit ``element`` come out NULL for the caller to drop.
    """
    one = get(value, *keys, as_type=element)
    return F.coalesce(
        get(value, *keys, as_type=f"array<{element}>"),
        F.when(one.isNotNull(), F.array(one)),
    )


def unwrap_or_self(value: Column | str, *keys: str) -> Column:
    """Step into each wrapper key that is there; otherwise stay where we are."""
    value = _col(value)
    for key in keys:
        inner = get(value, key)
        value = F.coalesce(F.when(~F.is_variant_null(inner), inner), value)
    return value


def scalar_text(value: Column | str) -> Column:
    """Text of a scalar; NULL for objects, arrays and JSON null."""
    return F.when(~is_array(value) & ~is_object(value), get(value, as_type="string"))


def text_node(value: Column | str, keys: tuple[str, ...] = ("#text", "_text", "text")) -> Column:
    """A scalar, or the text child of an object that an XML converter made of it."""
    return F.coalesce(scalar_text(value), *[F.nullif(get(value, k, as_type="string"), F.lit("")) for k in keys])


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def struct_ddl(fields: Mapping[str, str]) -> str:
    """``struct<...>`` type text; one cast of it reads all fields in a single pass."""
    return "struct<" + ",".join(f"{quote_name(n)}:{t}" for n, t in fields.items()) + ">"
