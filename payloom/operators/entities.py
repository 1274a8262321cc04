"""From declared trees to tables: typed explodes, one lazy plan per table.

Every table gets its own narrow chain. At each hop the list at the node's path
is cast in one go to ``array<struct<...>>`` holding just the scalars and the
one nested value that this table still needs, and exploded. Nothing else of
the payload is carried along, and no hop shuffles.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.functions.text import id_part
from payloom.functions.variant import OBJECT, get, is_array, is_object, non_empty_object, present, scalar_text, struct_ddl, text_node
from payloom.operators import keys as K
from payloom.operators.schema import root_value
from payloom.plans.spec import Field, Node, Pipeline, Root

ENTITY = "__entity"
VALUE = "__value"
LABEL = "__label"
# Column of a shared hop with what is at one key of its entities.
PART = "__part_{}"
# Tables below a node from which on its entities are written once for all of them. Warm runs in turn were
# faster with 6 than with 3 for the player feeds, whose trees have 9, 5 and 4 tables below a node.
SHARED_FROM = 6


class _Reader:
    """The struct type of one hop and how its fields become columns."""

    def __init__(self) -> None:
        self.types: dict[str, str] = {}

    def want(self, f: Field) -> None:
        self._add(f.json, f.type if f.read == "scalar" else "variant")

    def want_value(self, key: str) -> None:
        self._add(key, "variant")

    def want_object(self, path: tuple[str, ...], fields: tuple[Field, ...]) -> None:
        inner: dict[str, str] = {}
        for f in fields:
            inner[f.json] = f.type if f.read == "scalar" else "variant"
        ddl = struct_ddl(inner)
        for key in reversed(path[1:]):
            ddl = struct_ddl({key: ddl})
        self._add(path[0], ddl)

    def _add(self, key: str, ddl: str) -> None:
        # Two readers of one field: fall back to the raw value.
        self.types[key] = ddl if self.types.get(key, ddl) == ddl else "variant"

    def ddl(self) -> str:
        folded = [k.lower() for k in self.types]
        if len(set(folded)) < len(folded):
            return "variant"
        return struct_ddl(self.types)

    def value(self, entity: Column, f: Field, path: tuple[str, ...] = ()) -> Column:
        if self.ddl() == "variant":
            return _finish(get(entity, *path, f.json, as_type=f.type if f.read == "scalar" else "variant"), f)
        for i, key in enumerate(path):
            entity = entity.getField(key)
            if i == 0 and self.types[key] == "variant":
                return _finish(get(entity, *path[1:], f.json, as_type=f.type if f.read == "scalar" else "variant"), f)
        raw = entity.getField(f.json)
        if not path and self.types[f.json] == "variant" and f.read == "scalar":
            raw = get(raw, as_type=f.type)
        return _finish(raw, f)

    def nested(self, entity: Column, key: str) -> Column:
        return get(entity, key) if self.ddl() == "variant" else entity.getField(key)

    def want_place(self, path: tuple[str, ...]) -> None:
        if len(path) > 1:
            self.want_object(path[:-1], (Field(path[-1], path[-1], "variant"),))
        else:
            self.want_value(path[0])

    def place(self, entity: Column, path: tuple[str, ...]) -> Column:
        """The raw value at a path that was wanted as a place."""
        if self.ddl() == "variant":
            return get(entity, *path)
        for i, key in enumerate(path):
            entity = entity.getField(key)
            if i == 0 and self.types[key] == "variant":
                return get(entity, *path[1:]) if path[1:] else entity
        return entity


def _finish(value: Column, f: Field) -> Column:
    if f.read == "mixed":
        return scalar_text(value)
    if f.read == "text_node":
        return text_node(value)
    return value


def _list(value: Column, path: tuple[str, ...], list_key: str | None, ddl: str) -> Column:
    """A list, or a list of one: NULL in it if nothing fits, which the caller drops.

    Each reading is tried once per row; the typed casts are the costly part.
    """
    full = (*path, *([list_key] if list_key else []))
    options = [get(value, *full, as_type=f"array<{ddl}>"), F.array(get(value, *full, as_type=ddl))]
    if list_key:
        options.insert(0, get(value, *path, as_type=f"array<{ddl}>"))
    return F.coalesce(*options)


def _unwrapped_list(value: Column, key: str, ddl: str) -> Column:
    """``_list`` of what is at a wrapper's key, or of the value itself where there is nothing.

    A list there, as most are, is read in one go: no value of it is built again on the way.
    """
    inner = F.when(present(get(value, key)), F.array(get(value, key, as_type=ddl)))
    return F.coalesce(get(value, key, as_type=f"array<{ddl}>"), inner, _list(value, (), None, ddl))


def _list_below(value: Column, path: tuple[str, ...], ddl: str) -> Column:
    """``_list`` of what is at a path of a value, or of each of its elements, where the value is a list: one flat list.

    Typed from the whole value, so that nothing on the way is built again. Elements with single entities are read once more.
    """
    def below(item: str) -> Column:
        for key in reversed(path):
            item = struct_ddl({key: item})
        found = get(value, as_type=f"array<{item}>")
        for key in path:
            found = found.getField(key)
        return found

    lists = below(f"array<{ddl}>")
    mixed = F.zip_with(lists, below(ddl), lambda items, one: F.coalesce(items, F.array(one)))
    return F.coalesce(F.flatten(lists), F.flatten(mixed), _list(value, path, None, ddl))


def _passed_by(chain: tuple[Node, ...]) -> bool:
    """Whether a tree's root hands nothing down, so that its entities need not be opened to get to the next node's."""
    root, nxt = chain[0], chain[1]
    plain = isinstance(root.source, str) and root.source != "row" and not root.unwrap and root.take != "first" and not root.label
    return plain and not root.hand_down and len(nxt.path) == 1 and nxt.list_key is None and not nxt.named and not nxt.keyed


def _element_filter(root: Root) -> Column | None:
    if root.element is None:
        return None
    names = root.element if isinstance(root.element, tuple) else (root.element,)
    return F.col("l1element") == names[0] if len(names) == 1 else F.col("l1element").isin(*names)


def context_columns(pipe: Pipeline) -> dict[str, Column]:
    out: dict[str, Column] = {c: F.col(c) for c in pipe.row_columns}
    out.update({c: id_part("ingested_from", i, at_least=n) for c, (i, n) in pipe.id_parts.items()})
    out.update({c: F.lit(v) for c, v in pipe.constants.items()})
    return out


def only_tables(roots: tuple[Root, ...], wanted: Collection[str]) -> tuple[Root, ...]:
    """The same trees without the nodes that no wanted table needs."""
    def cut(node: Node) -> Node | None:
        below = tuple(c for c in map(cut, node.children) if c is not None)
        mine = node.table in wanted
        if not mine and not below:
            return None
        # What the cut children open still is not a scalar of this node.
        opened = (*node.opened, *[(*c.path, *([c.list_key] if c.list_key else [])) for c in node.children if c.path],
                  *[p for c in node.children for _, p in c.named])
        changes = {"opened": opened} if mine else {
            "table": None, "fields": (), "inline": (), "extra": (), "keys": (), "first_by": ()}
        return dataclasses.replace(node, children=below, **changes)

    return tuple(r for r in map(cut, roots) if r is not None)


@dataclasses.dataclass(frozen=True)
class _Hop:
    """Entities of one node, opened: their columns to carry and a part per key that leads on."""

    frame: DataFrame
    carried: tuple[str, ...]
    parts: tuple[str, ...]
    depth: int

    def part(self, key: str) -> Column:
        return F.col(PART.format(self.parts.index(key)))


def build_tables(df: DataFrame, roots: tuple[Root, ...], context: Mapping[str, Column], text: bool = True, spread: bool = False,
                 store: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """One lazy DataFrame per node that has a table name. Fields must be resolved.

    ``store`` writes a DataFrame and returns it as read from there. With it, a
    node with several tables below is opened once and written, and these tables
    read just the part they need of it, in place of the whole payload.
    """
    out: dict[str, DataFrame] = {}

    def visit(chain: tuple[Node, ...], hop: _Hop | None) -> None:
        node = chain[-1]
        if node.table is not None:
            if node.table in out:
                raise ValueError(f"two nodes write table {node.table!r}")
            out[node.table] = _table(df, chain, context, text, spread, hop)
        if store and _shareable(node):
            hop = _shared(df, chain, context, spread, hop, store)
        for child in node.children:
            visit((*chain, child), hop)

    for root in roots:
        visit((root,), None)
    return out


def _n_tables(node: Node) -> int:
    return sum((c.table is not None) + _n_tables(c) for c in node.children)


def _any_distinct(node: Node) -> bool:
    return node.distinct or any(map(_any_distinct, node.children))


def _shareable(node: Node) -> bool:
    # Places with names are read from the whole entity, and distinct rows are dealt out by payload.
    opens = getattr(node, "source", None) != "row" and all(c.path and not c.named for c in node.children)
    return opens and _n_tables(node) >= SHARED_FROM and not any(map(_any_distinct, node.children))


def _shared(df: DataFrame, chain: tuple[Node, ...], context: Mapping[str, Column], spread: bool, hop: _Hop | None,
            store: Callable[[DataFrame], DataFrame]) -> _Hop:
    node = chain[-1]
    keys = tuple(dict.fromkeys(c.path[0] for c in node.children))
    # As if a child were to follow, so that the node's entities are opened and not read out.
    frame, carried, _ = _descend(df, (*chain, node.children[0]), context, spread, hop, keys)
    return _Hop(store(frame), tuple(carried), keys, len(chain) - 1)


def _start(df: DataFrame, chain: tuple[Node, ...], context: Mapping[str, Column], spread: bool) -> tuple[DataFrame, dict[str, Column]]:
    """The bronze rows of the tree, dealt out where the tree asks for it, and what each of its rows carries."""
    root: Root = chain[0]
    cond = _element_filter(root)
    frame = df if cond is None else df.filter(cond)
    source_key = ("ingested_from", "ingested_at")
    if chain[-1].distinct and set(source_key) <= set(context) and root.source != "row":
        # Rows that repeat each other in full have one source and load time: payloads are dealt by
        # these, and what they explode into is made distinct where it is, without a shuffle.
        frame = frame.repartition(*source_key)
    elif spread and len(chain) > 1:
        # A few huge payload rows in a few splits: spread them before they multiply.
        # AQE sizes the result, so there is no partition count to outgrow.
        frame = frame.hint("rebalance")
    carried: dict[str, Column] = dict(context)
    carried.update({c: make() for c, make in root.context.items()})
    for f in root.l0_fields:
        carried[f.column] = _finish(get("l0payload", f.json, as_type=f.type if f.read == "scalar" else "variant"), f)
    return frame, carried


def _descend(df: DataFrame, chain: tuple[Node, ...], context: Mapping[str, Column], spread: bool, hop: _Hop | None,
             parts: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, Column], _Reader]:
    """Hop by hop down to the entities of the last node, from the bronze rows or from a shared hop.

    With ``parts``, down to the node before the last one: its entities' columns and a column per part.
    """
    if hop is None:
        frame, carried = _start(df, chain, context, spread)
    else:
        frame = hop.frame.select(*[F.col(K.quote(c)) for c in hop.carried], hop.part(chain[hop.depth + 1].path[0]).alias(VALUE))
        carried = {c: F.col(c) for c in hop.carried}
    reader = _Reader()
    # Keys that are still to be taken from VALUE.
    rest = chain[hop.depth + 1].path[1:] if hop is not None else ()
    passed = hop is None and len(chain) > (2 if parts else 1) and _passed_by(chain)
    for depth, node in enumerate(chain):
        if hop is not None and depth <= hop.depth:
            continue
        last = depth == len(chain) - 1
        stop = bool(parts) and depth == len(chain) - 2
        if node.passthrough is not None:
            carried = {c: v for c, v in carried.items() if c in node.passthrough}
        if depth == 0 and passed:
            continue
        if depth == 0 and node.source == "row":
            # The bronze row is the entity: nothing to open.
            frame = frame.select(*[v.alias(c) for c, v in carried.items()])
            entity = None
            reader = _Reader()
        else:
            reader = _Reader()
            if last:
                for f in (*node.fields, *node.extra):
                    reader.want(f)
                for path, _, fields in node.inline:
                    if fields:
                        reader.want_object(path, fields)
            else:
                for f in node.hand_down:
                    reader.want(f)
                for _, path in chain[depth + 1].named:
                    reader.want_place(path)
                if stop:
                    for key in parts:
                        reader.want_value(key)
                elif chain[depth + 1].path:
                    # Just what the next node opens, not all that is beside it on the way.
                    reader.want_place(chain[depth + 1].path)
            if not reader.types:
                reader.want_value("__none")
            frame = _open(frame, node, depth, chain, carried, reader, rest, passed and depth == 1)
            entity = F.col(ENTITY)
            if node.label:
                carried[node.label] = F.col(LABEL)
        carried = {c: F.col(LABEL if c == node.label else c) for c in carried}

        if not last:
            nxt = chain[depth + 1]
            for f in node.hand_down:
                carried[f.column] = reader.value(entity, f)
            if stop:
                opened = [reader.nested(entity, key).alias(PART.format(i)) for i, key in enumerate(parts)]
            elif nxt.named:
                # A row per place with its label, so that one read serves them all.
                places = [F.struct(F.lit(label).alias(LABEL), reader.place(entity, path).alias(VALUE)) for label, path in nxt.named]
                opened = [F.inline(F.array(*places))]
            else:
                opened = [reader.place(entity, nxt.path).alias(VALUE)]
            rest = ()
            frame = frame.select(*[v.alias(c) for c, v in carried.items()], *opened)
            carried = {c: F.col(c) for c in carried}
            if stop:
                break
    return frame, carried, reader


def _table(df: DataFrame, chain: tuple[Node, ...], context: Mapping[str, Column],
           text: bool, spread: bool, hop: _Hop | None = None) -> DataFrame:
    frame, carried, reader = _descend(df, chain, context, spread, hop)
    root, node, entity = chain[0], chain[-1], F.col(ENTITY)
    own: dict[str, Column] = {}
    types: dict[str, str] = {}
    for f, path in [*((f, ()) for f in (*node.fields, *node.extra)), *((f, path) for path, _, fs in node.inline for f in fs)]:
        value = reader.value(entity, f, path)
        if f.column in own:
            # A later source of a column counts where it has a value.
            same = types[f.column] == f.type
            before = own[f.column] if same else own[f.column].cast("string")
            value = F.coalesce(value if same else value.cast("string"), before)
        own[f.column], types[f.column] = value, f.type if types.get(f.column, f.type) == f.type else "string"
    if node.text_element:
        named = own.get(node.text_element, F.lit(None).cast("string"))
        own[node.text_element] = F.coalesce(named, scalar_text(VALUE))
    fixed = {c: F.lit(v).cast("string") for c, v in node.constants.items()}
    if node.own_wins:
        own = {c: F.coalesce(v, carried[c].cast("string")) if text and c in carried else v for c, v in own.items()}
        ordered = {**carried, **own, **fixed}
    else:
        ordered = {**own, **carried, **fixed}
    result = frame.select(*[v.alias(c) for c, v in ordered.items()])
    if node.require == "any_scalar" and own:
        checked = [f.column for _, _, fs in node.inline for f in fs] or list(own)
        result = result.filter(F.coalesce(*[F.col(K.quote(c)).cast("string") for c in checked]).isNotNull())
    if node.derive:
        result = result.withColumns({name: make() for name, make in node.derive.items()})
    result = result.drop(*[c for c in carried if c.startswith("__")])
    if node.where is not None:
        result = result.filter(node.where())
    if node.distinct or node.distinct_on:
        result = K.distinct_on(result, node.distinct_on)
    if node.first_by:
        result = K.first(result, node.first_by)
    if node.keys:
        result = K.latest(result, node.keys)
    if text:
        result = result.select(*[F.col(K.quote(c)).cast("string").alias(c) for c in result.columns])
    return result


def _open(frame: DataFrame, node: Node, depth: int, chain: tuple[Node, ...], carried: Mapping[str, Column],
          reader: _Reader, rest: tuple[str, ...] = (), from_root: bool = False) -> DataFrame:
    """Explode the node's entities into ENTITY (and VALUE where the raw value is needed)."""
    last = depth == len(chain) - 1
    raw = reader.ddl() == "variant" or (last and (node.require == "filled" or node.text_element is not None))
    ddl = "variant" if raw else reader.ddl()
    if depth == 0:
        # A single wrapper is looked through by the reading itself.
        wrapper = node.unwrap[0] if len(node.unwrap) == 1 else None
        source = root_value(node if wrapper is None else dataclasses.replace(node, unwrap=()))
        if node.unwrap or callable(node.source):
            # Its own projection, so the unwrapping runs once and not per reading.
            l0 = [F.col("l0payload")] if node.take == "first" else []
            frame = frame.select(*[v.alias(c) for c, v in carried.items()], *l0, source.alias(VALUE))
            carried, source = {c: F.col(c) for c in carried}, F.col(VALUE)
        items = _list(source, (), None, ddl) if wrapper is None else _unwrapped_list(source, wrapper, ddl)
        if node.take == "first":
            items = F.when(F.col("l0payload").isNotNull(), F.slice(items, 1, 1)).otherwise(items)
    elif node.named:
        items = _list(F.col(VALUE), (), None, ddl)
    elif node.keyed:
        items = _by_key(rest, ddl)
    elif from_root:
        items = _list_below(root_value(chain[0]), node.path, ddl)
    else:
        items = _list(F.col(VALUE), rest, node.list_key, ddl)
    out = VALUE if raw else ENTITY
    extra = [F.col(LABEL)] if node.named or node.keyed else []
    keep = [v.alias(c) for c, v in carried.items()]
    frame = frame.select(*keep, *(extra if node.named else []), F.explode(items).alias(out))
    if node.keyed and not node.named:
        frame = frame.select(*[F.col(c) for c in carried], F.col(out).getField("label").alias(LABEL),
                             F.col(out).getField("item").alias(out))
    if not raw:
        return frame.filter(F.col(ENTITY).isNotNull())
    if last and node.require == "filled":
        frame = frame.filter(non_empty_object(VALUE))
    as_entity = get(VALUE, as_type=reader.ddl())
    frame = frame.select(*[F.col(c) for c in carried], *extra, VALUE, as_entity.alias(ENTITY))
    if last and node.text_element:
        return frame.filter(F.col(ENTITY).isNotNull() | (scalar_text(VALUE).isNotNull() & ~is_array(VALUE)))
    return frame.filter(is_object(VALUE))


def _by_key(path: tuple[str, ...], ddl: str) -> Column:
    """The values of an object with their keys."""
    entries = F.map_entries(get(F.col(VALUE), *path, as_type=OBJECT))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("label"), (e["value"] if ddl == "variant" else get(e["value"], as_type=ddl)).alias("item")))
