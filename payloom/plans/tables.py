"""All tables of a pipeline from its bronze rows."""

from __future__ import annotations

import itertools
from collections.abc import Collection

from pyspark.sql import DataFrame

from payloom.functions.text import snake_case
from payloom.operators.entities import build_tables, context_columns, only_tables
from payloom.operators.flatten import TreePlan, discover, flatten, open_trees
from payloom.operators.schema import WholeKinds, infer_nodes, open_nodes, resolve
from payloom.plans.spec import AutoTree, Node, Pipeline, Root
from payloom.sources.bronze import stage


def table_name(pipe: Pipeline, suffix: str) -> str:
    return f"{pipe.prefix}_{suffix}" if suffix else pipe.prefix


Shapes = tuple[TreePlan | None, tuple[Root, ...]]


def plan_shapes(pipe: Pipeline, bronze: DataFrame, only: Collection[str] | None = None) -> Shapes:
    """Shapes of a pipeline's data: one job for all trees, discovered and declared, and one more per depth at which
    forced fields of discovered trees are mixed, if the schemas of whole payloads don't tell them. Keep it to run again."""
    roots = pipe.roots if only is None else only_tables(pipe.roots, _needed(pipe, only))
    declared = {t for r in pipe.roots for t in _tables_of(r)}
    discovered = pipe.auto and (only is None or not set(only) <= declared)
    trees = _needed_trees(pipe, only)
    wanted = [*(open_trees(bronze, trees) if discovered else ()), *open_nodes(roots)]
    kinds: WholeKinds = {}
    types = infer_nodes(bronze, wanted, kinds=kinds)
    tree = discover(bronze, trees, "", types=types, kinds=kinds) if discovered else None
    return tree, resolve(bronze, roots, pipe.text, pipe.raw_names, types)


def _tables_of(node: Node) -> list[str]:
    return [*([node.table] if node.table is not None else []), *[t for c in node.children for t in _tables_of(c)]]


def _needed_trees(pipe: Pipeline, only: Collection[str] | None) -> tuple[AutoTree, ...]:
    """Trees that tables in ``only`` are made of, as far as names tell it: the table of a tree's root always has the tree's alias.

    Any other table may be in each tree, and its name depends on all of them.
    """
    if only is None:
        return pipe.auto
    aliases = [snake_case(t.alias) for t in pipe.auto]
    rest = set(only) - {t for r in pipe.roots for t in _tables_of(r)}
    clear = all(aliases.count(t) == 1 and not any(t.startswith(f"{a}_") for a in aliases) for t in rest)
    return tuple(t for t, a in zip(pipe.auto, aliases) if a in rest) if clear else pipe.auto


def _needed(pipe: Pipeline, only: Collection[str]) -> set[str]:
    hidden = {t for r in pipe.roots for t in _tables_of(r) if t.startswith("__")}
    return {*only, *(hidden if pipe.post and not set(only) <= {t for r in pipe.roots for t in _tables_of(r)} else ())}


def pipeline_tables(pipe: Pipeline, bronze: DataFrame, shapes: Shapes | None = None, spread: bool = False,
                    only: Collection[str] | None = None, shared: str | None = None) -> dict[str, DataFrame]:
    """Suffix -> lazy DataFrame for every table of the pipeline, or for those in ``only``.

    ``shared``: a name in the shared checkpoint folder. Entities with several tables below are then opened
    and written there once, when this is called, and their tables read that in place of the payloads.
    """
    tree, roots = shapes or plan_shapes(pipe, bronze, only)
    if shapes and only is not None:
        roots = only_tables(roots, _needed(pipe, only))
    out = flatten(bronze, pipe.auto if shapes else _needed_trees(pipe, only), "", plan=tree, spread=spread, only=only) if tree else {}
    hops = itertools.count()

    def store(df: DataFrame) -> DataFrame:
        return stage(df, f"{shared}/hop_{next(hops)}", by=())

    made = build_tables(bronze, roots, context_columns(pipe), text=pipe.text, spread=spread, store=store if shared else None)
    extra = pipe.extend(bronze) if pipe.extend else {}
    for part in (made, extra):
        if set(part) & set(out):
            raise ValueError(f"{pipe.name}: two parts write {sorted(set(part) & set(out))}")
        out.update(part)
    if pipe.post and any(t.startswith("__") for t in out):
        out = pipe.post(out)
    return out if only is None else {t: out[t] for t in only}


def target_names(pipe: Pipeline, shapes: Shapes) -> list[str]:
    """Full names of all tables that a pipeline with these shapes writes, e.g. for a reset."""
    tree, roots = shapes
    found = [t for r in (*(tree.roots if tree else ()), *roots) for t in _tables_of(r)]
    if pipe.post:
        found = [t for t in found if not t.startswith("__")] + [""]
    return sorted({table_name(pipe, t) for t in found})
