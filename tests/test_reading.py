"""How payloads are read: only the sections that are asked for, and each value as few times as its shape allows."""

from __future__ import annotations

from payloom.operators.entities import build_tables
from payloom.plans.spec import Field, Node, Root
from payloom.suite.base import bronze_rows
from pyspark.sql import functions as F

TEAM = (Field("teamId", "team_id"),)
EVENT = (Field("SI", "si"), Field("T", "t"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def places(*paths, unwrap=("team",)):
    named = tuple((str(i + 1), p) for i, p in enumerate(paths))
    return Root(element="teams", unwrap=unwrap, hand_down=TEAM, children=(
        Node(table="stat", label="half", named=named, fields=EVENT),))


def stat_rows(df, root):
    made = build_tables(df, (root,), {"ingested_from": F.col("ingested_from")})["stat"]
    return made, sorted((tuple(r) for r in made.select("ingested_from", "team_id", "half", "si", "t").collect()), key=str)


def test_filter_on_an_element_leaves_out_the_other_sections(spark):
    df = spark.range(20).withColumn("n", F.expr("nullif(id % 4, 3)"))
    rows = bronze_rows(df, "concat('s_', id)", "timestamp'2024-01-01'", {
        "one": ("n = 1", {"a": "CAST(id AS string)"}), "most": ("n <= 1", [{"b": "'only in most'"}]), "all": ("true", {})})
    assert {r["l1element"]: r["count"] for r in rows.groupBy("l1element").count().collect()} == {"one": 5, "most": 10, "all": 20}
    one = rows.filter("l1element = 'one'")
    assert "only in most" not in plan_of(one)
    assert sorted(r[0] for r in one.selectExpr("to_json(payload)").collect()) == sorted(f'{{"a":"{i}"}}' for i in range(1, 20, 4))


def test_named_places_of_all_shapes_are_read_without_the_whole_entity(bronze):
    one = '{"teamId":"a","h1":{"stat":[{"SI":"1","T":"x"},{"SI":"1","T":"x"},5]},"h2":{"stat":{"SI":2}}}'
    payloads = {
        "list": f'{{"team":[{one},7,null]}}', "object": f'{{"team":{one}}}', "bare": one, "bare_list": f"[{one}]",
        "null_wrapper": f'{{"team":null,{one[1:]}', "scalar_wrapper": f'{{"team":3,{one[1:]}',
        "none": '{"team":[{"teamId":"b"},{"teamId":"c","h1":null,"h2":{"stat":null}},{"teamId":"d","h1":[],"h2":{"stat":[]}}]}',
        "empty": '{"team":[]}', "scalar": "4", "null": "null"}
    df = bronze([("teams", p, None, name) for name, p in payloads.items()])
    made, rows = stat_rows(df, places(("h1", "stat"), ("h2", "stat")))
    full = [("a", "1", "1", "x"), ("a", "1", "1", "x"), ("a", "2", "2", None)]
    assert rows == sorted([(name, *r) for name in ("list", "object", "bare", "bare_list", "null_wrapper") for r in full], key=str)
    # Lists of entities and places are opened by plain explodes of what they hold: no lambda, no copy of an entity.
    assert "lambda" not in plan_of(made) and "ArrayType(VariantType,true)" not in plan_of(made)


def test_named_places_below_one_key_and_beside_it(bronze):
    df = bronze([("teams", '[{"teamId":{"x":[{"SI":"1"}],"y":{"SI":"2"}},"z":[{"SI":"3"}],"Z":{"SI":"4"}}]')])
    _, rows = stat_rows(df, places(("teamId", "x"), ("teamId", "y"), ("z",), ("Z",), unwrap=()))
    assert [r[2:] for r in rows] == [("1", "1", None), ("2", "2", None), ("3", "3", None), ("4", "4", None)]
    assert {r[1] for r in rows} == {'{"x":[{"SI":"1"}],"y":{"SI":"2"}}'}
