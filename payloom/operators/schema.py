"""Schema of VARIANT data as Spark aggregates: one job for any number of nodes."""

from __future__ import annotations

import dataclasses
import logging
from collections.abc import Collection, Iterable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.functions.variant import OBJECT, as_list, get, is_object, struct_ddl, unwrap_or_self
from payloom.operators.frontier import KeyedRule, infer_by_level, profile_paths
from payloom.plans.spec import ALL, Field, Node, Root
from payloom.functions.text import snake_case

__all__ = ["infer_nodes", "infer_schema", "profile_paths", "resolve", "scalar_fields"]
LOG = logging.getLogger(__name__)
NodeKey = tuple
# Entities whose own schemas are longer, or of more kinds, are looked through level by level.
LONG_SCHEMA, MANY_SCHEMAS = 20_000, 500
# Values that are looked at first, to learn which fields there are beside those that no table is made of, and of how many
# kinds whole values are. With more than FEW_KINDS among them, entities are counted in their place.
FIRST_VALUES, FEW_KINDS = 100, 20


@contextmanager
def _names_as_written(spark: SparkSession):
    """Schemas of variants are merged by the session's rule for names; by default it takes ``teamId`` and ``TeamId`` for one."""
    name = "spark.sql.caseSensitive"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parse_schema(text: str | None) -> T.DataType:
    """Result of ``schema_of_variant_agg`` as a Spark type."""
    if text is None:
        return T.NullType()
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def entity_type(dtype: T.DataType) -> T.StructType | None:
    """Type of one entity: the root array is looked through. None if it is not an object."""
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype if isinstance(dtype, T.StructType) else None


def extract_type(dtype: T.DataType) -> str:
    """Type to read a scalar as; unknown and mixed values are read as text."""
    return "string" if isinstance(dtype, (T.NullType, T.VariantType)) else dtype.simpleString()


def infer_schema(df: DataFrame, col: str, *path: str) -> T.DataType:
    """Type of the entities at a path, over every row and list element.

    Lists and single objects are brought to the same shape before they are
    aggregated, so a field that is sometimes one and sometimes the other
    still resolves to an object type.
    """
    item = F.explode(as_list(col, *path)).alias("v")
    merged = df.select(item).agg(F.schema_of_variant_agg("v").alias("s"))
    with _names_as_written(df.sparkSession):
        return parse_schema(merged.first()["s"])


def root_value(root: Root) -> Column:
    source = root.source() if callable(root.source) else F.col(root.source)
    return unwrap_or_self(source, *root.unwrap)


def _items(value: Column, *path: str) -> Column:
    """Entities at a path; what is no entity is dropped after the explode."""
    # Without a path the value stays as it is: reading it would build it again.
    return F.coalesce(get(value, *path, as_type="array<variant>"), F.array(get(value, *path) if path else value))


def _child_items(entity: Column, node: Node) -> Column:
    if node.keyed:
        return F.coalesce(F.map_values(get(entity, *node.path, as_type=OBJECT)), F.array().cast("array<variant>"))
    if node.named:
        return F.concat(*[_items(entity, *path) for _, path in node.named])
    if node.list_key is None:
        return _items(entity, *node.path)
    return F.coalesce(get(entity, *node.path, as_type="array<variant>"), _items(entity, *node.path, node.list_key))


class _Reading:
    """A tree of steps from an entity to all entities whose type is wanted below it.

    Nodes with a common way to them share it, so each list is opened once.
    """

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.steps: dict[tuple, tuple[Node, _Reading]] = {}

    def at(self, chain: tuple[Node, ...]) -> _Reading:
        here = self
        for node in chain:
            key = (node.path, node.list_key, node.named, node.keyed)
            here = here.steps.setdefault(key, (node, _Reading()))[1]
        return here

    def pairs(self, entity: Column, section: Column) -> Column:
        """Array of (node, section, entity) for this entity and everything below it."""
        parts = [F.array(F.struct(F.lit(i).alias("node"), section.alias("section"), entity.alias("v"))) for i in self.ids]
        parts += [below.over(_child_items(entity, node), section) for node, below in self.steps.values()]
        return F.concat(*parts)

    def over(self, entities: Column, section: Column) -> Column:
        return F.flatten(F.transform(entities, lambda x: self.pairs(x, section)))


def _structs(places: list[tuple[int, str]]) -> list[Column]:
    return [F.struct(F.lit(n).alias("node"), F.lit(x).alias("section")) for n, x in places]


def _most_fields(dtype: T.DataType | None) -> int:
    """Fields of the widest object anywhere in a type."""
    if isinstance(dtype, T.ArrayType):
        return _most_fields(dtype.elementType)
    return max([len(dtype.fields), *(_most_fields(f.dataType) for f in dtype.fields)]) if isinstance(dtype, T.StructType) else 0


def _united(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """One type for two kinds of a value, as Spark merges variant schemas; None where that depends on its rules for numbers and times."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = _united(fields[f.name], f.dataType) if f.name in fields else f.dataType
        # Names are in order of their UTF-16 units, as in a variant.
        names = sorted(fields, key=lambda name: name.encode("utf-16-be", "surrogatepass"))
        return None if None in fields.values() else T.StructType([T.StructField(name, fields[name]) for name in names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = _united(a.elementType, b.elementType)
        return None if item is None else T.ArrayType(item)
    plain = (T.StringType, T.BooleanType, T.BinaryType, T.VariantType, T.StructType, T.ArrayType)
    return T.VariantType() if isinstance(a, plain) or isinstance(b, plain) else None


def _kind(own: Column) -> Column:
    """Decimals have as many types as digits: they don't make a schema another kind."""
    return F.when(own.contains("DECIMAL("), F.regexp_replace(own, r"DECIMAL\(\d+,\d+\)", "DECIMAL")).otherwise(own)


def _types_of_kinds(entities: DataFrame, n_places: int) -> tuple[list, list, dict]:
    """Places (node, section) with long schemas or many kinds, those whose schemas Spark has to merge, and the types of all others.

    One pass: entities are counted by their own schemas, of which the driver gets MANY_SCHEMAS a place at most.
    """
    own = entities.select("node", "section", F.schema_of_variant("v").alias("own"))
    kind = _kind(F.col("own"))
    kinds = own.groupBy("node", "section", F.when(F.octet_length("own") <= LONG_SCHEMA, kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    most = int(MANY_SCHEMAS * n_places)
    rows = kinds.limit(most + 1).collect()
    if len(rows) > most:
        # Which places these are takes a pass of its own, in which each place is one row.
        sizes = own.groupBy("node", "section").agg(F.max(F.octet_length("own")).alias("longest"), F.approx_count_distinct(kind).alias("kinds")).collect()
        wide = [(r["node"], r["section"]) for r in sizes if r["longest"] > LONG_SCHEMA or r["kinds"] > MANY_SCHEMAS]
        return wide, [at for r in sizes if (at := (r["node"], r["section"])) not in wide], {}
    found: dict[tuple[int, str], list[str | None]] = {}
    for r in rows:
        found.setdefault((r["node"], r["section"]), []).append(r["kind"])
    wide, merging, types = [], [], {}
    for at, texts in found.items():
        if None in texts or len(texts) > MANY_SCHEMAS:
            wide.append(at)
            continue
        united: T.DataType | None = T.NullType()
        for text in sorted(texts):
            united = None if united is None or "DECIMAL" in text else _united(united, parse_schema(text))
        if united is None:
            merging.append(at)
        else:
            types[at] = entity_type(united)
    return wide, merging, types


def _names(root: Root, elements: set[str]) -> list[str] | None:
    """Elements that a reading is made of; None for all."""
    return sorted(elements) or (list(root.element) if root.element is not None else None)


def _entities(df: DataFrame, readings: Iterable[tuple[Root, set[str], _Reading]]) -> DataFrame:
    """The entities (node, section, v) of all rows."""
    pairs = []
    for root, elements, top in readings:
        section = F.col("l1element") if elements else F.lit("")
        found = top.over(_items(root_value(root)), section)
        names = _names(root, elements)
        if names:
            found = F.when(F.col("l1element").isin(*names), found)
        pairs.append(F.coalesce(found, F.array().cast("array<struct<node:int,section:string,v:variant>>")))
    return df.select(F.inline(F.concat(*pairs))).filter(is_object("v"))


def _outline(dtype: T.DataType, left_out: Collection[str] = ()) -> T.DataType:
    """Objects and lists of a type without some of its fields; scalars are all one."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_outline(dtype.elementType, left_out))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _outline(f.dataType, left_out)) for f in dtype.fields if f.name not in left_out])
    return dtype if isinstance(dtype, (T.NullType, T.VariantType)) else T.StringType()


def _objects(dtype: T.DataType, steps: tuple[str | None, ...] = ()) -> dict[tuple[str | None, ...], T.StructType]:
    """All objects of a type by the way to them: names, and None for the elements of a list."""
    if isinstance(dtype, T.ArrayType):
        return _objects(dtype.elementType, (*steps, None))
    if not isinstance(dtype, T.StructType):
        return {}
    return {steps: dtype} | {way: st for f in dtype.fields for way, st in _objects(f.dataType, (*steps, f.name)).items()}


def _n_fields(dtype: T.DataType) -> int:
    return sum(len(st.fields) for st in _objects(dtype).values())


def _opened_ddl(dtype: T.DataType) -> str:
    """Type that opens objects and lists of objects and reads all else as it is."""
    if isinstance(dtype, T.StructType):
        return struct_ddl({f.name: _opened_ddl(f.dataType) for f in dtype.fields})
    return f"array<{_opened_ddl(dtype.elementType)}>" if _objects(dtype) else "variant"


def _known_at(value: Column, steps: tuple[str | None, ...], names: Collection[str]) -> Column:
    """Whether all objects at a place have these names only; NULL or false where there is one that is no object."""
    ddl = "map<string,struct<__none:variant>>"
    for step in reversed(steps):
        ddl = f"array<{ddl}>" if step is None else struct_ddl({step: ddl})

    def known(at: Column, rest: tuple[str | None, ...]) -> Column:
        if not rest:
            return F.forall(F.map_keys(at), lambda key: key.isin(*names))
        return F.forall(at, lambda x: known(x, rest[1:])) if rest[0] is None else known(at.getField(rest[0]), rest[1:])

    return known(get(value, as_type=ddl), steps)


def _flat_at(value: Column, outline: T.DataType) -> Column:
    """Whether nothing in an opened value holds an object but the objects that the outline has."""
    if isinstance(outline, T.StructType):
        return reduce(Column.__and__, [F.coalesce(_flat_at(value.getField(f.name), f.dataType), F.lit(True)) for f in outline.fields])
    if _objects(outline):
        return F.forall(value, lambda x: _flat_at(x, outline.elementType))
    return ~F.contains(F.schema_of_variant(value), F.lit("OBJECT<"))


def _without(value: Column, seen: T.DataType | None, left_out: Collection[str]) -> tuple[Column, Column] | None:
    """Whether a value is like those seen but for fields that are left out, and what it is without them.

    None where this is no less to read. A value with any name that was not seen, or with something else in place
    of an object or a list of objects, or an object in place of something else, is not like them: whatever was seen,
    no field is missed, and the names of all values that are like them are known.
    """
    if seen is None or not left_out:
        return None
    outline = _outline(seen, left_out)
    objects = _objects(outline)
    plain = all(st.fields and len({f.name.lower() for f in st.fields}) == len(st.fields) for st in objects.values())
    if not objects or not plain or 2 * _n_fields(outline) + len(objects) > _n_fields(seen):
        return None
    known = [_known_at(value, way, sorted({*left_out, *st.fieldNames()})) for way, st in objects.items()]
    opened = get(value, as_type=_opened_ddl(outline))
    return F.coalesce(reduce(Column.__and__, [*known, _flat_at(opened, outline)]), F.lit(False)), F.to_variant_object(opened)


def _first_seen(df: DataFrame, value: Column) -> T.DataType | None:
    """Objects and lists of a few values; None if they are of different kinds."""
    own = F.schema_of_variant(value)
    rows = df.select(F.when(F.octet_length(own) > LONG_SCHEMA, "").otherwise(own).alias("own")).limit(FIRST_VALUES).collect()
    united: T.DataType | None = T.NullType()
    for text in sorted({r["own"] for r in rows} - {None}):
        united = _united(united, _outline(parse_schema(text))) if text and united is not None else None
    return united


class _Hidden(Exception):
    """The schema of a whole value doesn't tell the type of what is below."""


def _seen_at(dtype: T.DataType, path: tuple[str, ...]) -> T.DataType:
    for key in path:
        # Digits of decimals are cut out of a schema's text, be they in a name.
        if isinstance(dtype, T.VariantType) or "DECIMAL(" in key:
            raise _Hidden
        fields = {f.name: f.dataType for f in dtype.fields} if isinstance(dtype, T.StructType) else {}
        dtype = fields.get(key, T.NullType())
    return dtype


def _seen_items(dtype: T.DataType) -> T.DataType:
    """Type of ``_items``: items' types are merged in a list's schema, where those that are no objects hide those that are."""
    item = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    if isinstance(item, T.VariantType):
        raise _Hidden
    return item


def _seen_child_items(entity: T.DataType, node: Node) -> list[T.DataType]:
    """Types of ``_child_items`` of an entity."""
    if not isinstance(entity, T.StructType):
        return []
    if node.keyed:
        raise _Hidden
    if node.named:
        return [_seen_items(_seen_at(entity, path)) for _, path in node.named]
    at = _seen_at(entity, node.path)
    if isinstance(at, T.VariantType):
        raise _Hidden
    return [_seen_items(at if node.list_key is None or isinstance(at, T.ArrayType) else _seen_at(at, (node.list_key,)))]


# Schemas of the whole values of a source, by where they are from, and whether names or digits of decimals may be cut in them.
WholeKinds = dict[tuple, list[tuple[T.DataType, bool]]]


def _type_below(kinds: list[tuple[T.DataType, bool]], chain: tuple[Node, ...]) -> T.DataType | None:
    """Type of all entities below whole values of these kinds, None if there are none; VARIANT where Spark has to merge their schemas.

    No list is opened: an error is raised where the schemas of whole values don't tell it.
    """
    united: T.DataType | None = T.NullType()
    for whole, cut in kinds:
        entities = [_seen_items(whole)]
        for node in chain:
            entities = [x for entity in entities for x in _seen_child_items(entity, node)]
        for entity in entities:
            if isinstance(entity, T.StructType):
                merge = united is None or cut and "decimal" in entity.simpleString().lower()
                united = None if merge else _united(united, entity)
    return T.VariantType() if united is None else entity_type(united)


def _kinds_of_whole(df: DataFrame, readings: Iterable[tuple[Root, set[str], _Reading]]) -> tuple[WholeKinds, bool] | None:
    """The kinds of whole values by their reading's number and section, and whether nothing is left out of them. None where they are too long or too many.

    Values are counted by their own schemas as they are: no list is opened and no entity built again. Fields that
    readings of nothing but whole values leave out may be missing.
    """
    readings = list(readings)
    named = sorted({e for root, elements, _ in readings for e in _names(root, elements) or ()})
    direct = not any(top.steps for _, _, top in readings)
    values, alike, own, rest = {}, {}, {}, {}
    for i, (root, elements, _) in enumerate(readings):
        names = _names(root, elements)
        value = root_value(root)
        values[f"value_{i}"] = F.when(F.col("l1element").isin(*names), value) if names else value
        value, like = F.col(f"value_{i}"), F.col(f"alike_{i}")
        # Values of several elements are not seen apart.
        seen = _first_seen(df, values[f"value_{i}"]) if direct and root.left_out and len(names or ()) == 1 else None
        without = _without(value, seen, root.left_out)
        if without is not None:
            alike[f"alike_{i}"], rest[f"rest_{i}"] = without[0], F.when(like, without[1])
        own[f"own_{i}"] = F.schema_of_variant(value if without is None else F.when(~like, value))
    section = F.when(F.col("l1element").isin(*named), F.col("l1element")) if named else F.lit(None).cast("string")
    # Each step is a projection of its own, so that nothing is made twice.
    read = df.select(section.alias("section"), *[c.alias(name) for name, c in values.items()])
    read = read.select("*", *[c.alias(name) for name, c in alike.items()]) if alike else read
    # To print a schema takes longer than to build the value. The names of values that are alike are known, so theirs are merged and printed once.
    printed = read.select("section", *[c.alias(name) for name, c in {**own, **rest}.items()])
    by = ["section", *[F.when(F.octet_length(name) > LONG_SCHEMA, "").otherwise(_kind(F.col(name))).alias(name) for name in own]]
    # Wholes may be of many kinds where their entities are of few: the first values tell whether to count them.
    first = [] if direct else set(printed.select(*by).limit(FIRST_VALUES).collect())
    if len(first) > FEW_KINDS or any("" in r[1:] for r in first):
        return None
    kinds = printed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.schema_of_variant_agg(name).alias(name) for name in rest])
    most = int(MANY_SCHEMAS * (len(named) or 1))
    rows = kinds.limit(most + 1).collect()
    if len(rows) > most:
        return None
    texts: dict[tuple[int, str], set[str]] = {}
    for r in rows:
        for i, (_, elements, _) in enumerate(readings):
            if not elements or r["section"] in elements:
                texts.setdefault((i, r["section"] if elements else ""), set()).update({r[name] for name in (f"own_{i}", f"rest_{i}") if name in kinds.columns} - {None})
    if any("" in found or len(found) > MANY_SCHEMAS for found in texts.values()):
        return None
    return {at: [(parse_schema(text), "DECIMAL" in text) for text in sorted(found)] for at, found in texts.items()}, not rest


def infer_nodes(df: DataFrame, wanted: list[tuple[NodeKey, Root, tuple[Node, ...], tuple[str, ...]]],
                rule: KeyedRule | None = None, kinds: WholeKinds | None = None) -> dict:
    """Entity types of many nodes at once, keyed as given.

    Each entry is (key, root, nodes below the root, path of an inlined object).
    Roots that differ in nothing but their element share one reading.

    One job counts whole values by their own schemas, which are few where values are of few kinds: lists stay unopened, and the
    driver takes the types of all nodes from these schemas and unites them. Fields that all who want nothing but whole values leave out may then be
    missing in the types. Where schemas of whole values are long, of many kinds or don't tell the type of a node, every row yields its (node, entity) pairs,
    which are counted by their own schemas. Only where numbers or times of several types meet does one more job merge the schemas of all entities.
    Nodes with long schemas or many kinds, and those in which an object came out with many fields, may have objects
    whose keys are data: they are looked through level by level, and ``rule`` decides. Names are taken as they are written.

    ``kinds`` takes the schemas of whole values; given again with the same rows, it answers for nodes that they tell without a job.
    """
    rule = rule or KeyedRule()
    known = {}
    for key, root, chain, inner in wanted if kinds else ():
        try:
            dtype = _type_below(kinds[_whole(root)], (*chain, *([Node(path=inner)] if inner else [])))
        except (KeyError, _Hidden):
            continue
        if not isinstance(dtype, T.VariantType) and _most_fields(dtype) < rule.many:
            known[key] = dtype
    wanted = [w for w in wanted if w[0] not in known]
    if not wanted:
        return known
    readings: dict[tuple, tuple[Root, set, _Reading]] = {}
    n_nodes = 0
    owner: dict[int, tuple[int, str]] = {}
    ways: dict[tuple[int, str], tuple[tuple, tuple[Node, ...]]] = {}
    for i, (_, root, chain, inner) in enumerate(wanted):
        single = isinstance(root.element, str)
        source = _whole(root)[:2] if single else _whole(root)
        one, elements, top = readings.get(source, (root, set(), _Reading()))
        # What one table leaves out another one may be made of.
        readings[source] = (dataclasses.replace(one, left_out=one.left_out & root.left_out), elements, top)
        if single:
            elements.add(root.element)
        below = (*chain, *([Node(path=inner)] if inner else []))
        spot = top.at(below)
        if not spot.ids:
            spot.ids.append(n_nodes)
            n_nodes += 1
        owner[i] = (spot.ids[0], root.element if single else "")
        ways[owner[i]] = source, below

    needed = {e for _, r, _, _ in wanted for e in (r.element if isinstance(r.element, tuple) else (r.element,))}
    if None not in needed:
        df = df.filter(F.col("l1element").isin(*sorted(needed)))
    entities = _entities(df, readings.values())
    place = F.struct("node", "section")
    with _names_as_written(df.sparkSession):
        whole = None if any(root.unwrap for root, _, _ in readings.values()) else _kinds_of_whole(df, readings.values())
        if whole is None:
            n_places = sum(len(elements) or 1 for _, elements, _ in readings.values()) * n_nodes
            wide, merging, types = _types_of_kinds(entities, n_places)
        else:
            found, all_fields = whole
            numbers = {source: i for i, source in enumerate(readings)}
            wide, merging, types, hidden = [], [], {}, []
            for at, (source, below) in ways.items():
                try:
                    dtype = _type_below(found.get((numbers[source], at[1]), []), below)
                except _Hidden:
                    hidden.append(at)
                    continue
                if isinstance(dtype, T.VariantType):
                    merging.append(at)
                elif dtype is not None:
                    types[at] = dtype
            if hidden:
                wide, more, opened = _types_of_kinds(entities.filter(place.isin(*_structs(hidden))), len(hidden))
                merging, types = merging + more, types | opened
            if kinds is not None and all_fields:
                for source, (root, elements, _) in readings.items():
                    kinds.update({_whole(root, e): found.get((numbers[source], e or ""), []) for e in elements or (None,)})
        if merging:
            merged = entities.filter(place.isin(*_structs(merging))).groupBy("node", "section").agg(F.schema_of_variant_agg("v").alias("s"))
            types |= {(r["node"], r["section"]): entity_type(parse_schema(r["s"])) for r in merged.collect()}
    wide += [at for at, dtype in types.items() if _most_fields(dtype) >= rule.many]
    if wide:
        types |= infer_by_level(entities.filter(place.isin(*_structs(wide))), rule)
    return known | {key: types.get(owner[i]) for i, (key, *_) in enumerate(wanted)}


def _whole(root: Root, element: str | None = None) -> tuple:
    """What the whole values of a root are known by."""
    return root.source, root.unwrap, element or root.element


def scalar_fields(schema: T.StructType | None, prefix: str = "", text: bool = True,
                  exclude: Collection[str] = (), raw_names: bool = False, spellings: list[str] | None = None) -> tuple[Field, ...]:
    """Scalars of an entity type as spec fields, under their snake_case names.

    Of several spellings of one column the first keeps its name, the others
    are numbered and added to ``spellings``: no value is lost, and one stray field stops no load.
    """
    out: dict[str, Field] = {}
    for f in (schema.fields if schema is not None else ()):
        if f.name in exclude or isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            continue
        mixed = isinstance(f.dataType, T.VariantType)
        column = wanted = prefix + (f.name if raw_names else snake_case(f.name))
        if column.lower() in out:
            column = numbered(wanted, {*out, *((prefix + (g.name if raw_names else snake_case(g.name))).lower() for g in schema.fields)})
            if spellings is not None:
                spellings.append(f"{f.name} AS {column}")
            LOG.warning("fields %r and %r both become column %r: the second one is %r", out[wanted.lower()].json, f.name, wanted, column)
        out[column.lower()] = Field(f.name, column, "string" if text else extract_type(f.dataType),
                            "mixed" if mixed and text else "scalar")
    return tuple(out.values())


def numbered(name: str, taken: Collection[str]) -> str:
    """The name with the first number that makes it new."""
    n = 2
    while f"{name}_{n}".lower() in taken:
        n += 1
    return f"{name}_{n}"


def opened_fields(node: Node, below: tuple[str, ...] = ()) -> set[str]:
    """Fields of an entity (or of an object in it) that the node inlines or its children open."""
    paths = [path for path, _, _ in node.inline] + list(node.opened)
    for child in node.children:
        paths += [(*child.path, *([child.list_key] if child.list_key else [])), *[p for _, p in child.named]]
    n = len(below)
    return {p[n] for p in paths if len(p) > n and p[:n] == below}


def open_nodes(roots: tuple[Root, ...]) -> list:
    """What ``infer_nodes`` has to look up for the "*" of declared trees."""
    wanted: list = []

    def ask(root: Root, node: Node, chain: tuple[Node, ...], key: NodeKey) -> None:
        if node.fields == ALL:
            wanted.append((key, root, chain, ()))
        for j, (path, _, fields) in enumerate(node.inline):
            if fields == ALL:
                wanted.append(((*key, "inline", j), root, chain, path))
        for j, child in enumerate(node.children):
            ask(root, child, (*chain, child), (*key, j))

    for i, root in enumerate(roots):
        ask(root, root, (), (i,))
    return wanted


def resolve(df: DataFrame, roots: tuple[Root, ...], text: bool = True,
            raw_names: bool = False, types: dict | None = None) -> tuple[Root, ...]:
    """The same trees with every "*" replaced by the fields that the data has.

    One inference job for all nodes together, none if everything is declared or
    ``types`` holds what was inferred for ``open_nodes`` already.
    """
    types = infer_nodes(df, open_nodes(roots)) if types is None else types

    def fill(node: Node, key: NodeKey) -> Node:
        changes: dict = {}
        if node.fields == ALL:
            # Fields that the tree opens are not scalars, even where their shape is mixed.
            special = {f.json for f in node.extra}
            changes["fields"] = scalar_fields(
                types.get(key), "", text, {*node.exclude, *opened_fields(node), *special}, raw_names)
        if node.inline:
            changes["inline"] = tuple(
                (path, prefix,
                 scalar_fields(types.get((*key, "inline", j)), prefix, text,
                               {*node.exclude, *opened_fields(node, path)}, raw_names)
                 if fields == ALL else fields)
                for j, (path, prefix, fields) in enumerate(node.inline)
            )
        if node.children:
            changes["children"] = tuple(fill(c, (*key, j)) for j, c in enumerate(node.children))
        return dataclasses.replace(node, **changes) if changes else node

    return tuple(fill(r, (i,)) for i, r in enumerate(roots))
