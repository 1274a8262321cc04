"""Declarative description of a flatten: what to read, never how to schedule it.

A pipeline names a source, a scope and trees of nodes. Each node with a table
name becomes one lazy DataFrame. Specs are plain frozen data on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

ALL = "*"


@dataclass(frozen=True)
class Field:
    """One scalar of an entity: where it is in the payload and what to call it."""

    json: str
    column: str
    type: str = "string"
    # "scalar": plain typed read; "mixed": scalars only, nested values are NULL;
    # "text_node": scalar or the text child of an object.
    read: str = "scalar"


@dataclass(frozen=True)
class Node:
    """Entities at a path below their parent, and the table they become."""

    table: str | None = None
    # Keys from the parent entity to this node; a list or one object may be there.
    path: tuple[str, ...] = ()
    # Last key of the path that is missing when the list sits there directly.
    list_key: str | None = None
    # "*" takes every scalar of the inferred schema.
    fields: str | tuple[Field, ...] = ()
    # (path of an object, column prefix, its fields): scalars of child objects.
    inline: tuple[tuple[tuple[str, ...], str, str | tuple[Field, ...]], ...] = ()
    # Several named places instead of one path, e.g. a list per half of a game:
    # (label, path) pairs whose entities share the table, told apart by ``label``.
    named: tuple[tuple[str, tuple[str, ...]], ...] = ()
    label: str | None = None
    # The object at the path has data as keys: its values are the entities, and ``label`` takes the keys.
    keyed: bool = False
    # Scalars of this entity that every descendant row carries.
    hand_down: tuple[Field, ...] = ()
    constants: Mapping[str, str | None] = field(default_factory=dict)
    # Computed columns over the finished row, by name.
    derive: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    first_by: tuple[str, ...] = ()
    distinct_on: tuple[str, ...] = ()
    # Drop rows that repeat another row in full.
    distinct: bool = False
    # None, "filled" (object with a key) or "any_scalar" (a non-null inlined
    # column, or own column where nothing is inlined).
    require: str | None = None
    # More fields beside "*", for values that need their own kind of read.
    extra: tuple[Field, ...] = ()
    # Row filter over the finished row.
    where: Callable[[], Column] | None = None
    # Column that takes the text of list elements that are plain scalars.
    text_element: str | None = None
    # Fields left out of "*".
    exclude: tuple[str, ...] = ()
    # Paths that hold no scalars of this node, beside those of its own children.
    opened: tuple[tuple[str, ...], ...] = ()
    # Payload values beat context columns of the same name.
    own_wins: bool = False
    # Subset of inherited columns that reach this table and its children.
    passthrough: tuple[str, ...] | None = None
    children: tuple[Node, ...] = ()


@dataclass(frozen=True)
class Root(Node):
    """A tree of one element (section) of the source."""

    element: str | tuple[str, ...] | None = None
    # "payload", "l0payload", "row" (the bronze row itself is the entity), or a
    # function that returns the VARIANT column to start from.
    source: str | Callable[[], Column] = "payload"
    # More columns of the bronze row that every row of the tree carries.
    context: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    # Wrapper keys around the entities, any of which may be missing.
    unwrap: tuple[str, ...] = ()
    # L0 mode: scalars of the l0 payload that every row of the tree carries.
    l0_fields: tuple[Field, ...] = ()
    # "all" payload elements, or only the "first" (as some feeds expect).
    take: str = "all"
    # Names that no table is made of, at any depth: inference may leave such fields out.
    left_out: frozenset[str] = frozenset()


@dataclass(frozen=True)
class AutoTree:
    """One element whose tree is discovered from the data."""

    element: str
    alias: str
    exclude: frozenset[str] = frozenset()
    # Fields that are lists even where only single objects were seen.
    force_list: frozenset[str] = frozenset()
    # Object fields whose scalars become prefixed columns.
    flatten_structs: Mapping[str, str] = field(default_factory=dict)
    # Alias or full alias path -> key columns.
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    # Full alias paths that get no table of their own.
    suppress: frozenset[str] = frozenset()
    static: Mapping[str, str] = field(default_factory=dict)
    type_overrides: Mapping[str, str] = field(default_factory=dict)
    passthrough: tuple[str, ...] | None = None
    l0_array: str = "all"
    # Arrays of plain scalars, at any depth: "drop", "keep" (JSON text) or "explode".
    scalar_arrays: str = "drop"


@dataclass(frozen=True)
class Pipeline:
    """A named source with everything that is made of it."""

    name: str
    source: str
    prefix: str
    # Scope of one run: "<prefix>_{competition_id}_{season}", "" for the whole source.
    scope: str = ""
    # True: the id is exactly the scope; False: more parts may follow it.
    scope_exact: bool = False
    auto: tuple[AutoTree, ...] = ()
    roots: tuple[Root, ...] = ()
    # Columns parsed from the id: name -> (index, least number of parts).
    id_parts: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    constants: Mapping[str, str] = field(default_factory=dict)
    # True: every column of the declared trees is text; False: inferred types.
    text: bool = True
    # Keep the payload's own field names instead of snake_case.
    raw_names: bool = False
    row_columns: tuple[str, ...] = ("ingested_from", "ingested_at")
    # More tables straight from the bronze rows.
    extend: Callable[[DataFrame], dict[str, DataFrame]] | None = None
    post: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None
    write_mode: str = "append"
    # A few huge payloads per load: deal them out before they are exploded.
    spread: bool = False
    # Many tables of one element: a run opens it once for all of them, if it has a shared checkpoint folder.
    shared: bool = False

    @property
    def elements(self) -> tuple[str, ...]:
        out: list[str] = [a.element for a in self.auto]
        for root in self.roots:
            wanted = root.element if isinstance(root.element, tuple) else (root.element,)
            out.extend(e for e in wanted if e)
        return tuple(dict.fromkeys(out))
