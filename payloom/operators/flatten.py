"""Whole-tree flatten: discover the tree of an element, then build its tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.functions.text import snake_case
from payloom.operators.entities import build_tables, only_tables
from payloom.operators.schema import WholeKinds, infer_nodes, numbered, scalar_fields
from payloom.plans.spec import AutoTree, Field, Node, Root


MAP_KEY = "map_key"


@dataclass
class _Draft:
    """A node under discovery."""

    tree: AutoTree
    alias: str
    alias_path: str
    path: tuple[str, ...]
    chain: tuple[Node, ...]
    type: T.StructType | None = None
    scalar_list: bool = False
    keyed: bool = False
    children: list[_Draft] = field(default_factory=list)
    spellings: list[str] = field(default_factory=list)
    fields: list[Field] = field(default_factory=list)
    inline: list[tuple[tuple[str, ...], str, tuple[Field, ...]]] = field(default_factory=list)


@dataclass(frozen=True)
class TreePlan:
    """Discovered trees, ready to build, with what a user should know about them.

    dropped: paths that no table shows. mixed: fields of several shapes that
    became one JSON text column. unused: names in options (keys, force_list,
    suppress, type_overrides) that nothing in the data answers to. spellings: fields
    whose column got a number, as another spelling of it is there. keyed: objects whose
    keys are data; their tables have a row per key, in column ``map_key``.
    """

    roots: tuple[Root, ...]
    statics: tuple[dict[str, str], ...]
    dropped: tuple[str, ...]
    mixed: tuple[str, ...] = ()
    unused: tuple[str, ...] = ()
    spellings: tuple[str, ...] = ()
    keyed: tuple[str, ...] = ()


def open_trees(df: DataFrame, trees: tuple[AutoTree, ...]) -> list:
    """What ``infer_nodes`` has to look up first to discover trees."""
    sources = [("payload", "payload"), *([("l0", "l0payload")] if "l0payload" in df.columns else [])]
    return [((kind, i), Root(element=t.element, source=column, left_out=frozenset(t.exclude)), (), ()) for kind, column in sources for i, t in enumerate(trees)]


def discover(df: DataFrame, trees: tuple[AutoTree, ...], prefix: str, strict: bool = False, types: dict | None = None,
             kinds: WholeKinds | None = None) -> TreePlan:
    """Find every table of the given elements.

    One inference job serves all elements; forced fields whose shape is still mixed are resolved by the
    schemas of whole values (``kinds``), or by a further job for all those of one depth together. ``strict``
    makes option names that match nothing an error; else the plan reports them,
    as a window of a feed may lack a field that others have. ``types``: what was
    inferred for ``open_trees`` already.
    """
    roots = [Root(element=t.element) for t in trees]
    kinds = {} if kinds is None else kinds
    types = infer_nodes(df, open_trees(df, trees), kinds=kinds) if types is None else types

    dropped: list[str] = []
    mixed: list[str] = []
    drafts = [_Draft(t, t.alias, t.alias, (), (), types[("payload", i)]) for i, t in enumerate(trees)]
    open_drafts = list(drafts)
    while open_drafts:
        unresolved: list[_Draft] = []
        for d in open_drafts:
            _expand(d, unresolved, dropped, mixed)
        open_drafts = unresolved
        if unresolved:
            index = {t.element: r for t, r in zip(trees, roots)}
            found = infer_nodes(df, [((j,), index[d.tree.element], d.chain, ()) for j, d in enumerate(unresolved)], kinds=kinds)
            for j, d in enumerate(unresolved):
                d.type = found[(j,)]

    names = _table_names(drafts, prefix)
    out = []
    for i, (tree, draft) in enumerate(zip(trees, drafts)):
        l0_type = types.get(("l0", i))
        l0_fields = _fields(l0_type, tree) if l0_type is not None else ()
        out.append(_root(tree, draft, l0_fields, names))
    unused = tuple(x for tree, draft in zip(trees, drafts) for x in _unused(tree, draft))
    if strict and unused:
        raise ValueError(f"options that match nothing: {', '.join(unused)}")
    nodes = [d for draft in drafts for d in _walk(draft)]
    spellings = tuple(x for d in nodes for x in d.spellings)
    return TreePlan(tuple(out), tuple(dict(t.static) for t in trees), tuple(dropped), tuple(mixed), unused, spellings, tuple(d.alias_path for d in nodes if d.keyed))


def _unused(tree: AutoTree, draft: _Draft) -> list[str]:
    """Option names that no table, field or column answers to."""
    nodes = _walk(draft)
    tables = {n for d in nodes for n in (d.alias_path, d.alias, snake_case(d.alias))}
    fields = {k for d in nodes for k in d.path}
    columns = {c for d in nodes for c in _own_columns(d)}
    wanted = (("keys", tree.keys, tables), ("force_list", tree.force_list, fields), ("suppress", tree.suppress, {d.alias_path for d in nodes}),
              ("type_overrides", tree.type_overrides, columns))
    return [f"{tree.element}.{option}:{name}" for option, names, known in wanted for name in sorted(names) if name not in known]


def _fields(dtype: T.StructType | None, tree: AutoTree, skip: frozenset[str] = frozenset(), spellings: list[str] | None = None) -> tuple[Field, ...]:
    found = scalar_fields(dtype, text=False, exclude=tree.exclude | skip, spellings=spellings)
    return tuple(_override(f, tree) for f in found)


def _override(f: Field, tree: AutoTree) -> Field:
    return Field(f.json, f.column, tree.type_overrides[f.column]) if f.column in tree.type_overrides else f


def _expand(d: _Draft, unresolved: list[_Draft], dropped: list[str], mixed: list[str]) -> None:
    tree = d.tree

    def child(path: tuple[str, ...], dtype: T.DataType | None, scalar_list: bool = False, keyed: bool = False) -> None:
        name = path[-1]
        node = _Draft(tree, name, f"{d.alias_path}.{'.'.join(path)}", path, (*d.chain, Node(path=path, keyed=keyed)),
                      dtype if isinstance(dtype, T.StructType) else None, scalar_list, keyed)
        d.children.append(node)
        if node.type is not None:
            _expand(node, unresolved, dropped, mixed)
        elif not scalar_list:
            unresolved.append(node)

    def walk(st: T.StructType, prefix: tuple[str, ...]) -> None:
        for f in st.fields:
            if f.name in tree.exclude:
                continue
            path = (*prefix, f.name)
            forced = f.name in tree.force_list
            if isinstance(f.dataType, T.ArrayType):
                item = f.dataType.elementType
                if isinstance(item, T.StructType):
                    child(path, item)
                elif forced and isinstance(item, T.VariantType):
                    child(path, None)
                elif tree.scalar_arrays == "explode":
                    child(path, None, scalar_list=True)
                elif tree.scalar_arrays == "keep":
                    kept = Field(f.name, snake_case("_".join(path)), "string")
                    if prefix:
                        d.inline.append((prefix, "", (kept,)))
                    else:
                        d.fields.append(kept)
                else:
                    dropped.append(f"{d.alias_path}.{'.'.join(path)}[]")
            elif isinstance(f.dataType, T.MapType):
                value = f.dataType.valueType
                if isinstance(value, (T.ArrayType, T.MapType)):
                    dropped.append(f"{d.alias_path}.{'.'.join(path)}{{}}")
                else:
                    child(path, value, scalar_list=not isinstance(value, T.StructType), keyed=True)
            elif isinstance(f.dataType, T.StructType):
                if forced:
                    child(path, f.dataType)
                    continue
                if not prefix and f.name in tree.flatten_structs:
                    scalars = scalar_fields(f.dataType, tree.flatten_structs[f.name], text=False, exclude=tree.exclude, spellings=d.spellings)
                    d.inline.append((path, "", tuple(_override(s, tree) for s in scalars)))
                else:
                    dropped.extend(f"{d.alias_path}.{'.'.join(path)}.{s.name}" for s in f.dataType.fields
                                   if not isinstance(s.dataType, (T.StructType, T.ArrayType))
                                   and s.name not in tree.exclude)
                walk(f.dataType, path)
            elif forced and isinstance(f.dataType, T.VariantType):
                child(path, None)
            elif isinstance(f.dataType, T.VariantType):
                mixed.append(f"{d.alias_path}.{'.'.join(path)}")

    if d.type is not None:
        walk(d.type, ())
        children = frozenset(c.path[0] for c in d.children)
        d.fields = [*_fields(d.type, tree, children, d.spellings), *d.fields]
        d.spellings = [f"{d.alias_path}.{x}" for x in d.spellings]


def _walk(d: _Draft) -> list[_Draft]:
    return [d, *[x for c in d.children for x in _walk(c)]]


def _table_names(drafts: list[_Draft], prefix: str) -> dict[str, str]:
    """Leaf alias where it is unique, the whole alias path where it is not."""
    every = [x for d in drafts for x in _walk(d) if x.alias_path not in x.tree.suppress]
    leaf: dict[str, int] = {}
    for x in every:
        leaf[snake_case(x.alias)] = leaf.get(snake_case(x.alias), 0) + 1
    names = {}
    for x in every:
        short = snake_case(x.alias)
        tail = short if leaf[short] == 1 or "." not in x.alias_path else snake_case(x.alias_path.replace(".", "_"))
        names[x.alias_path] = f"{prefix}_{tail}" if prefix else tail
    # Spellings of one name in one place: the first one keeps it, the others are numbered.
    taken: set[str] = set()
    for path in sorted(names):
        if names[path] in taken:
            names[path] = numbered(names[path], {*taken, *names.values()})
        taken.add(names[path])
    return names


def _keys(tree: AutoTree, d: _Draft) -> tuple[str, ...]:
    for name in (d.alias_path, d.alias, snake_case(d.alias)):
        if name in tree.keys:
            return tuple(tree.keys[name])
    return ()


def _context_name(column: str, below: Collection[str]) -> str:
    """The nearer level keeps a name: a source column that a payload column hides is renamed."""
    return f"bronze_{column}" if column in below else column


def _payload_columns(node: Node) -> set[str]:
    own = {f.column for f in node.fields} | {f.column for _, _, fs in node.inline for f in fs}
    return own.union(*map(_payload_columns, node.children))


def _own_columns(d: _Draft) -> list[str]:
    return [f.column for f in d.fields] + [f.column for _, _, fs in d.inline for f in fs]


def _root(tree: AutoTree, draft: _Draft, l0_fields: tuple[Field, ...], names: dict[str, str]) -> Root:
    below = {c for x in _walk(draft) for c in _own_columns(x)}
    base = [_context_name(c, below) for c in ("ingested_at", "ingested_from", *tree.static)]
    l0_fields = tuple(
        Field(f.json, f"{snake_case(draft.alias)}_{f.column}" if f.column in below else f.column, f.type)
        for f in l0_fields
    )
    if tree.passthrough is not None:
        l0_fields = tuple(f for f in l0_fields if f.column in tree.passthrough)
    inherited = tuple(c for c in (*base, *[f.column for f in l0_fields])
                      if tree.passthrough is None or c in tree.passthrough)

    def build(d: _Draft, inherited: tuple[str, ...]) -> dict:
        label = (MAP_KEY if MAP_KEY not in _own_columns(d) else f"{snake_case(d.alias)}_{MAP_KEY}") if d.keyed else None
        own = [*([label] if label else []), *_own_columns(d), *(["value"] if d.scalar_list else [])]
        keys = _keys(tree, d)
        missing = [k for k in keys if k not in own and k not in inherited]
        if missing:
            raise ValueError(f"keys {missing} of {d.alias_path!r} are not columns of its table "
                             f"(has {sorted({*own, *inherited})})")
        under = {c for x in _walk(d)[1:] for c in _own_columns(x)}
        plain = {f.column: f for f in d.fields}
        down = tuple(
            Field(plain[k].json, f"{snake_case(d.alias)}_{k}" if k in under else k, plain[k].type)
            for k in keys if k in plain
            and (tree.passthrough is None or k in tree.passthrough)
        )
        below = (*inherited, *([label] if label else []), *[f.column for f in down])
        return dict(
            table=None if d.alias_path in tree.suppress else names[d.alias_path],
            path=d.path, fields=tuple(d.fields), inline=tuple(d.inline), hand_down=down, keys=keys,
            text_element="value" if d.scalar_list else None, keyed=d.keyed, label=label,
            constants={},
            children=tuple(Node(**build(c, below)) for c in d.children),
        )

    return Root(element=tree.element, l0_fields=l0_fields,
                take="first" if tree.l0_array == "first" else "all", **build(draft, inherited))


def flatten(df: DataFrame, trees: tuple[AutoTree, ...] | AutoTree, prefix: str = "",
            plan: TreePlan | None = None, spread: bool = False, only: Collection[str] | None = None) -> dict[str, DataFrame]:
    """All tables of the given elements as lazy DataFrames.

    Pass a stored ``plan`` to skip discovery, e.g. when yesterday's shape is known.
    """
    trees = (trees,) if isinstance(trees, AutoTree) else trees
    plan = plan or discover(df, trees, prefix)
    out: dict[str, DataFrame] = {}
    for tree, root, static in zip(trees, plan.roots, plan.statics):
        kept = (root,) if only is None else only_tables((root,), only)
        below = _payload_columns(root)
        context: dict[str, Column] = {_context_name(c, below): F.col(c) for c in ("ingested_at", "ingested_from")}
        context.update({_context_name(c, below): F.lit(v) for c, v in static.items()})
        if tree.passthrough is not None:
            context = {c: v for c, v in context.items() if c in tree.passthrough}
        made = build_tables(df, kept, context, text=False, spread=spread)
        if set(made) & set(out):
            raise ValueError(f"two elements write {sorted(set(made) & set(out))}")
        out.update(made)
    return out
