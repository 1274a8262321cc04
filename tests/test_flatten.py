import pytest
from pyspark.sql import functions as F

from payloom.operators.flatten import discover, flatten
from payloom.plans.spec import AutoTree


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_root_array_and_single_object_children(bronze):
    df = bronze([
        ("p", '[{"playerId":"1","competitions":{"competition":{"competitionId":"111"}}},'
              '{"playerId":"2","competitions":{"competition":[{"competitionId":"111"},{"competitionId":"5"}]}},'
              '{"playerId":"3","competitions":{"competition":[]}}, {"playerId":"4","competitions":null}]'),
    ])
    tree = AutoTree("p", "players", force_list=frozenset({"competition"}),
                    keys={"players": ("player_id",), "competition": ("player_id", "competition_id")})
    out = flatten(df, tree, "assoc")
    assert set(out) == {"assoc_players", "assoc_competition"}
    assert rows(out["assoc_players"], "player_id") == [("1",), ("2",), ("3",), ("4",)]
    assert rows(out["assoc_competition"], "player_id", "competition_id") == [("1", "111"), ("2", "111"), ("2", "5")]


def test_mixed_root_shapes_nulls_and_latest(bronze):
    df = bronze([
        ("t", '{"teamId":"1","v":1}', None, "a", "2024-01-01 00:00:00"),
        ("t", '[{"teamId":"1","v":2},{"teamId":"2","v":3}]', None, "b", "2024-01-02 00:00:00"),
        ("t", "null"), ("t", None), ("t", "[]"), ("t", "{bad"),
    ])
    out = flatten(df, AutoTree("t", "team", keys={"team": ("team_id",)}))
    assert rows(out["team"], "team_id", "v", "ingested_from") == [("1", 2, "b"), ("2", 3, "b")]


def test_l0_scalars_reach_every_table_and_rows_without_l0_stay(bronze):
    df = bronze([
        ("player", '[{"teamId":"9"},{"teamId":"8"}]', '{"playerId":"7","x":1.25}'),
        ("player", '[{"teamId":"5"}]', None),
    ])
    out = flatten(df, AutoTree("player", "player"))
    assert rows(out["player"], "player_id", "team_id") == [("7", "8"), ("7", "9"), (None, "5")]
    one = flatten(df, AutoTree("player", "player", l0_array="first"))
    assert rows(one["player"], "player_id", "team_id") == [("7", "9"), (None, "5")]


def test_inline_structs_exclude_static_suppress_and_overrides(bronze):
    df = bronze([("g", '{"gameId":1,"score":{"points":10,"tries":2,"skip":1},"skip":3,'
                       '"teams":{"teamsMatch":[{"teamId":"1","flag":true}]}}')])
    tree = AutoTree("g", "game", exclude=frozenset({"skip"}), flatten_structs={"score": "score_"},
                    static={"sport": "x"}, keys={"game": ("game_id",), "teamsMatch": ("game_id", "team_id")},
                    type_overrides={"game_id": "string"}, suppress=frozenset())
    out = flatten(df, tree)
    assert out["game"].columns == ["game_id", "score_points", "score_tries", "ingested_at", "ingested_from", "sport"]
    assert rows(out["game"], "game_id", "score_points", "sport") == [("1", 10, "x")]
    assert rows(out["teams_match"], "game_id", "team_id", "flag") == [("1", "1", True)]
    hidden = flatten(df, AutoTree("g", "game", suppress=frozenset({"game"})))
    assert set(hidden) == {"teams_match"}


def test_same_leaf_name_in_two_branches_gets_path_names(bronze):
    df = bronze([("a", '{"x":{"stat":[{"i":1}]},"y":{"stat":[{"i":2}]}}')])
    out = flatten(df, AutoTree("a", "a"))
    assert set(out) == {"a", "a_x_stat", "a_y_stat"}
    assert rows(out["a_y_stat"], "i") == [(2,)]


def test_ancestor_key_with_the_same_name_is_renamed(bronze):
    df = bronze([("s", '{"id":"s1","round":[{"id":"r1"},{"id":"r2"}]}')])
    out = flatten(df, AutoTree("s", "season", keys={"season": ("id",), "round": ("id",)}))
    assert rows(out["round"], "season_id", "id") == [("s1", "r1"), ("s1", "r2")]


def test_odd_names_and_types(bronze):
    df = bronze([("o", '{"a.b":1,"teamID":2,"x":1.25,"big":123456789012345678901234567890,"flag":true,"n":null,"m":1}'),
                 ("o", '{"m":"s"}')])
    out = flatten(df, AutoTree("o", "o"))["o"]
    types = dict(out.dtypes)
    assert types["x"].startswith("decimal") and types["big"].startswith("decimal") and types["m"] == "string"
    assert (1, 2, True, "1") in rows(out, "`a.b`", "team_id", "flag", "m")


def test_scalar_arrays_modes_and_report(bronze):
    df = bronze([("o", '{"id":1,"tags":["a","b"]}')])
    tree = AutoTree("o", "o", keys={"o": ("id",)})
    assert discover(df, (tree,), "").dropped == ("o.tags[]",)
    keep = flatten(df, AutoTree("o", "o", scalar_arrays="keep"))["o"]
    assert rows(keep, "id", "tags") == [(1, '["a","b"]')]
    split = flatten(df, AutoTree("o", "o", scalar_arrays="explode", keys={"o": ("id",)}))
    assert rows(split["tags"], "id", "value") == [(1, "a"), (1, "b")]


def test_report_of_mixed_fields_and_unused_options(bronze):
    df = bronze([("o", '{"id":1,"x":{"a":1},"y":{"tags":[1]}}'), ("o", '{"id":2,"x":[{"a":1}]}')])
    tree = AutoTree("o", "o", keys={"o": ("id",), "typo": ("id",)}, force_list=frozenset({"nope"}), type_overrides={"id": "string", "no_column": "int"}, scalar_arrays="keep")
    plan = discover(df, (tree,), "")
    assert plan.mixed == ("o.x",) and plan.dropped == ()
    assert plan.unused == ("o.keys:typo", "o.force_list:nope", "o.type_overrides:no_column")
    with pytest.raises(ValueError, match="typo"):
        discover(df, (tree,), "", strict=True)
    assert rows(flatten(df, tree, plan=plan)["o"], "id", "y_tags") == [("1", "[1]"), ("2", None)]


def test_payload_columns_hide_source_columns(bronze):
    df = bronze([("o", '{"ingestedAt":"x","c":[{"v":1}]}')])
    out = flatten(df, AutoTree("o", "o"))
    assert rows(out["o"], "ingested_at") == [("x",)] and "bronze_ingested_at" in out["o"].columns
    assert "bronze_ingested_at" in out["c"].columns


def test_unknown_key_fails_before_any_table_runs(bronze):
    df = bronze([("o", '{"id":1,"c":[{"x":1}]}')])
    with pytest.raises(ValueError, match="player_id"):
        flatten(df, AutoTree("o", "o", keys={"c": ("player_id",)}))


def test_spellings_of_one_column_are_numbered_and_reported(bronze):
    df = bronze([("o", '{"teamID":1,"teamId":2,"team_id_2":3}')])
    plan = discover(df, (AutoTree("o", "o"),), "")
    assert plan.spellings == ("o.teamId AS team_id_3",)
    assert rows(flatten(df, AutoTree("o", "o"), plan=plan)["o"], "team_id", "team_id_2", "team_id_3") == [(1, 3, 2)]


def test_names_that_differ_in_case_keep_all_values(bronze):
    df = bronze([("o", '{"teamId":1,"Sub":[{"x":1}]}'), ("o", '{"TeamId":2,"sub":[{"X":2}]}'), ("o", '{"teamid":3}')]).repartition(3)
    plan = discover(df, (AutoTree("o", "o"),), "")
    out = flatten(df, AutoTree("o", "o"), plan=plan)
    assert rows(out["o"], "team_id", "team_id_2", "teamid") == sorted([(None, 1, None), (2, None, None), (None, None, 3)], key=repr)
    assert plan.spellings == ("o.teamId AS team_id_2",)
    assert sorted(sum((rows(out[t], "x") for t in out if "sub" in t), [])) == [(1,), (2,)]


def keyed_bronze(bronze, n, extra=""):
    made = [("o", '{"id":%d,"byPlayer":{%s}%s}' % (k, ",".join(f'"p{k * 7 + j}":{{"pts":{j},"w":"{k}","tags":[{{"t":{j}}}]}}' for j in range(3)), extra)) for k in range(n)]
    return bronze(made)


def test_objects_keyed_by_data_become_tables(bronze):
    df = keyed_bronze(bronze, 700, ',"flags":{"a":1}')
    tree = AutoTree("o", "o", keys={"o": ("id",), "byPlayer": ("id", "map_key")})
    plan = discover(df, (tree,), "")
    assert plan.keyed == ("o.byPlayer",) and plan.dropped == ("o.flags.a",)
    out = flatten(df, tree, plan=plan)
    assert rows(out["by_player"], "id", "map_key", "pts", "w") == sorted([(k, f"p{k * 7 + j}", j, str(k)) for k in range(700) for j in range(3)], key=repr)
    assert rows(out["tags"], "id", "map_key", "t") == sorted([(k, f"p{k * 7 + j}", j) for k in range(700) for j in range(3)], key=repr)


def test_keyed_scalars_and_one_wide_row(bronze):
    df = bronze([("o", '{"id":1,"score":{%s},"few":{"a":1,"b":2}}' % ",".join(f'"k{j}":{j}' for j in range(3000)))])
    plan = discover(df, (AutoTree("o", "o", keys={"o": ("id",)}),), "")
    out = flatten(df, AutoTree("o", "o", keys={"o": ("id",)}), plan=plan)
    assert plan.keyed == ("o.score",) and plan.dropped == ("o.few.a", "o.few.b")
    assert rows(out["score"], "id", "map_key", "value") == sorted([(1, f"k{j}", str(j)) for j in range(3000)], key=repr)


def test_level_by_level_types_equal_merged_schemas(spark):
    from payloom.operators.frontier import KeyedRule, infer_by_level
    from payloom.operators.schema import infer_schema
    from pyspark.sql import functions as F

    texts = ['{"a":1,"b":[1,2.5],"c":{"d":null,"e":"x"},"f":[],"m":1,"n":1.25,"o":1e3}', '{"a":2.75,"b":[null],"c":{"d":true,"g":[[{"h":1}]]},"m":"s","n":700,"o":1}',
             '{"c":{},"p":{"q":1},"r":[{"s":1},{"t":[]}]}', '{"p":[1],"a":123456789012345678901234567890,"u":null,"É.x":"y"}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("v")).repartition(3)
    found = infer_by_level(df.select(F.lit(0).alias("node"), F.lit("").alias("section"), "v"), KeyedRule())[(0, "")]
    assert found == infer_schema(df, "v")


def test_plan_can_be_reused_without_inference(bronze):
    df = bronze([("o", '[{"id":1,"c":{"d":[{"x":1}]}}]')])
    tree = AutoTree("o", "o", keys={"o": ("id",)})
    plan = discover(df, (tree,), "p")
    out = flatten(df, tree, "p", plan=plan)
    assert rows(out["p_d"], "id", "x") == [(1, 1)]


def test_opened_fields_hold_only_their_own_names(spark):
    from payloom.operators.frontier import opened
    text_of = "concat('{', array_join(transform(sequence(1, 2000), i -> concat('\"key', i, '\":{\"a\":', i, '}')), ','), '}')"
    rows = opened(spark.range(1).select("id", F.parse_json(F.expr(text_of)).alias("v"))).collect()
    assert sorted(r["pos"] for r in rows) == list(range(2000)) and {r["id"] for r in rows} == {0}
    assert all(r["value"].toPython() == {"a": int(r["key"][3:])} for r in rows)
    assert max(len(r["value"].metadata) for r in rows) < 50


def test_opened_values_of_all_shapes(spark):
    from payloom.operators.frontier import opened
    texts = ['{"a":null,"b":[1]}', '[null,2,{"c":3}]', "{}", "[]", "4", "null", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", F.parse_json("t").alias("v"))
    found = {(r["id"], r["pos"], r["key"], None if r["value"] is None else r["value"].toJson()) for r in opened(df).collect()}
    assert found == {(0, 0, "a", "null"), (0, 1, "b", "[1]"), (1, 0, None, "null"), (1, 1, None, "2"), (1, 2, None, '{"c":3}')}


def test_types_are_found_in_one_pass(spark):
    from payloom.operators.schema import infer_nodes
    from payloom.plans.spec import Root
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    text_of = "concat('{\"id\":', id, if(id % 2 = 0, ',\"x\":{\"y\":\"z\"}', ',\"x\":[]'), '}')"
    df = spark.range(200).mapInArrow(counted, "id long").select(F.lit("e").alias("l1element"), F.parse_json(F.expr(text_of)).alias("payload"))
    found = infer_nodes(df, [("k", Root(element="e"), (), ())])["k"]
    assert found.simpleString() == "struct<id:bigint,x:variant>" and read.value == 200


def test_types_of_kinds_equal_those_that_spark_merges(spark, monkeypatch):
    import random

    from payloom.operators import schema
    from payloom.plans.spec import Root
    random.seed(3)

    def value(depth):
        pick = random.randrange(12 if depth else 9)
        if pick < 9:
            return ["null", '"t"', "true", "1", "2.5", "3.25e0", "1e300", '"u"', "12345678901234567890"][pick]
        if pick == 9:
            return "[" + ",".join(value(depth - 1) for _ in range(random.randrange(3))) + "]"
        return "{" + ",".join(f'"{k}":{value(depth - 1)}' for k in random.sample(["a", "A", "b c", "é", "z"], random.randrange(4))) + "}"

    groups = [[f'{{"v":{value(2)},"w":{value(2)}}}' for _ in range(3)] for _ in range(60)]
    rows = [(f"e{i}", t) for i, texts in enumerate(groups) for t in texts]
    df = spark.createDataFrame(rows, "l1element string, t string").select("l1element", F.parse_json("t").alias("payload")).localCheckpoint()
    wanted = [(i, Root(element=f"e{i}"), (), ()) for i in range(len(groups))]
    found = schema.infer_nodes(df, wanted)
    with schema._names_as_written(spark):
        merged = {r["l1element"]: r["s"] for r in df.groupBy("l1element").agg(F.schema_of_variant_agg("payload").alias("s")).collect()}
    assert {f"e{i}": t for i, t in found.items()} == {e: schema.parse_schema(s) for e, s in merged.items()}
    # With more kinds than the driver takes, places are sized and merged as a whole.
    monkeypatch.setattr(schema, "MANY_SCHEMAS", 0.5)
    monkeypatch.setattr(schema, "infer_by_level", lambda entities, rule: {(r["node"], r["section"]): "wide" for r in entities.select("node", "section").distinct().collect()})
    assert set(schema.infer_nodes(df, wanted).values()) == {"wide"}


def test_whole_values_are_counted_without_opening_their_lists(bronze, monkeypatch):
    from payloom.operators import schema

    opened = []
    kinds = schema._types_of_kinds
    monkeypatch.setattr(schema, "_types_of_kinds", lambda *a, **k: opened.append(1) or kinds(*a, **k))

    def types(*payloads, l0=None):
        df = bronze([("t", p, l0) for p in payloads])
        wanted = [(source, schema.Root(element="t", source=source), (), ()) for source in ("payload", "l0payload")]
        got = schema.infer_nodes(df, wanted)
        return *(got[s].simpleString() if got[s] else None for s in ("payload", "l0payload")), bool(opened)

    same = '{"a":"1","B":{"c":[{"d":"x"},{"e":null}]}}', '[{"a":"2","b":"y"},{"a":null,"B":{"c":[]}}]', "[]", "null", '"text"', None, "[[1]]"
    assert types(*same, l0='{"g":"1"}') == ("struct<B:struct<c:array<struct<d:string,e:void>>>,a:string,b:string>", "struct<g:string>", False)
    assert types('{"a":1}', '[{"a":2.5},{"a":"x"}]') == ("struct<a:variant>", None, False)
    assert types('{"a":1}', '{"a":2.5}', '[{"a":10.25}]') == ("struct<a:decimal(22,2)>", None, False)
    # The schema of this list doesn't tell its object's: it is opened.
    assert types('{"a":"1"}', '[{"b":"2"},"text"]') == ("struct<a:string,b:string>", None, True)


def test_whole_values_tell_the_types_of_all_nodes(spark, bronze, monkeypatch):
    import random

    from payloom.operators import schema
    from payloom.plans.catalog import pipeline
    from payloom.plans.spec import Node, Root
    from payloom.plans.tables import plan_shapes

    # Declared nodes and forced fields of several shapes are typed without a list being opened.
    opened = []
    kinds = schema._types_of_kinds
    monkeypatch.setattr(schema, "_types_of_kinds", lambda *a: opened.append(1) or kinds(*a))
    player = '{"playerId":"1","playerStats":{"tackles":"2"}}'
    team = '{{"team_id":"1","teamLineup":{{"teamPlayer":{},"insAndOuts":{{"insOuts":{{"player_id":"3"}}}}}},"teamCoaches":{{"teamCoach":[{{"coach_id":"4"}}]}}}}'
    df = bronze([("teams", p, '{"game_id":"9"}') for p in (f'{{"teamsMatch":{team.format(player)}}}', f'[{{"teamsMatch":[{team.format(f"[{player}]")}]}}]')])
    tree, roots = plan_shapes(pipeline("matchdata"), df)
    assert not opened and not tree.mixed and [c.table for c in tree.roots[1].children] == ["teams_match"]
    assert [f.column for f in roots[1].children[0].children[0].inline[0][2]] == ["player_stats_tackles"]

    def value(depth):
        pick = random.randrange(13 if depth else 6)
        if pick < 6:
            return ["null", '"t"', "true", "1", number, "{}"][pick]
        if pick < 7:
            return "[" + ",".join(value(depth - 1) for _ in range(random.randrange(3))) + "]"
        return "{" + ",".join(f'"{k}":{value(depth - 1)}' for k in random.sample(["a", "A", "b", odd], random.randrange(1, 4))) + "}"

    random.seed(11)
    steps = [Node(path=("a",)), Node(path=("a", "b")), Node(path=("b",), list_key="a"), Node(path=("DECIMAL(2,1)",)), Node(path=("A",)),
             Node(named=(("1", ("a",)), ("2", ("b", "A")))), Node(path=("b",), keyed=True), Node(path=("b",))]
    def top():
        one = f'{{"a":{value(3)},"b":{value(3)},"A":{value(2)}}}'
        return random.choice([one, f"[{one}]", f'[{one},{{"a":{value(2)}}}]'])

    groups = []
    for i in range(25):
        number, odd = ("2.5", "DECIMAL(2,1)") if i % 4 == 0 else ("3", "c d")
        groups.append([top() for _ in range(3)])
    df = spark.createDataFrame([(f"e{i}", t) for i, texts in enumerate(groups) for t in texts], "l1element string, t string").select(
        "l1element", F.parse_json("t").alias("payload"), F.parse_json("t").alias("l0payload")).localCheckpoint()
    wanted = []
    for i in range(len(groups)):
        chains = [(), *[(step,) for step in steps], *[tuple(random.sample(steps, 2)) for _ in range(4)]]
        wanted += [((i, j), Root(element=f"e{i}"), chain, random.choice([(), (), (), ("a",), ("b", "A")])) for j, chain in enumerate(chains)]
    wanted.append(("all", Root(source="l0payload"), (steps[0],), ()))
    monkeypatch.setattr(schema, "FEW_KINDS", -1)
    exact = schema.infer_nodes(df, wanted)
    monkeypatch.setattr(schema, "FEW_KINDS", 1000)
    store: dict = {}
    assert schema.infer_nodes(df, wanted, kinds=store) == exact and store
    del opened[:]
    told = schema.infer_nodes(df.filter("false"), wanted, kinds=store)
    # What was counted before answers for the same nodes again; here only what it can't tell is read, from no rows.
    assert sum(t is not None for t in told.values()) > 50 and all(t is None or t == exact[k] for k, t in told.items())


def test_fields_left_out_are_not_looked_at_and_no_other_is_missed(bronze, monkeypatch):
    import random

    from payloom.operators import schema

    monkeypatch.setattr(schema, "FIRST_VALUES", 2)
    usual = '{"team":[{"id":"1","big":{"s":[{"a":"x","b":"y","c":"z","d":"w"}]},"more":{"e":"1","f":"2","g":"3"}}]}'
    left_out = frozenset({"big", "more"})

    def types(texts, **root):
        return schema.infer_nodes(bronze([("t", x) for x in texts]).coalesce(1), [("k", schema.Root(element="t", **root), (), ())])["k"]

    def others(dtype):
        if isinstance(dtype, schema.T.StructType):
            return {f.name: others(f.dataType) for f in dtype.fields if f.name not in left_out}
        return [others(dtype.elementType)] if isinstance(dtype, schema.T.ArrayType) else dtype

    assert types([usual] * 4, left_out=left_out).simpleString() == "struct<team:array<struct<id:string>>>"
    assert "big" in types([usual] * 4).simpleString()
    odd = ('{"team":[{"id":"1","new":"2"}]}', '{"team":[{"id":"1"},null]}', '{"team":{"id":"1"}}', '{"team":[{"ID":"1"}],"x":"1"}', '{"team":[]}', "{}",
           '{"team":"text"}', '{"team":[{"id":1}]}', '{"team":[{"id":{"v":"1"}}]}', '{"team":[{"id":["1"]},{"big":1}]}', '{"team":[[{"id":"1"}]]}',
           '[{"team":[{"id":"1"}]},{"y":true}]', "null", None, '"text"', '{"team":[{"id":null,"more":[{"z":1}]}]}', '{"big":{"id":"1"}}')
    random.seed(5)
    for texts in [[x] for x in odd] + [random.sample(odd, 4) for _ in range(8)]:
        texts = [usual, usual, *texts, usual]
        assert others(types(texts, left_out=left_out)) == others(types(texts)), texts
    # Names that are data are counted by value, where they are in place of a scalar as well.
    merged = []
    without = schema._without
    monkeypatch.setattr(schema, "_without", lambda *a: merged.append(without(*a)) or merged[-1])
    df = bronze([("t", x) for x in (usual, '{"team":[{"id":{"k1":"1"}}]}', '{"team":[{"id":[{"k2":"1"}]}]}')]).coalesce(1)
    monkeypatch.setattr(schema, "FIRST_VALUES", 1)
    schema.infer_nodes(df, [("k", schema.Root(element="t", left_out=left_out), (), ())])
    assert [r[0] for r in df.select(F.col("payload").alias("value_0")).select(merged[0][0]).collect()] == [True, False, False]
    # What one table leaves out another one is made of.
    df = bronze([("t", usual)] * 3)
    wanted = [(i, schema.Root(element="t", left_out=x), (), ()) for i, x in enumerate((left_out, frozenset()))]
    assert all("big" in t.simpleString() for t in schema.infer_nodes(df, wanted).values())


def test_nodes_below_a_root_are_read_from_the_whole_value(bronze):
    import itertools

    from payloom.operators.entities import build_tables
    from payloom.plans.spec import Field, Node, Root

    shapes = ['{"a":%s}', '[{"a":%s}]', '[{"a":%s},{"a":{"x":"9","b":{"c":[{"y":"8"},null,4]}}},{},null,7,[{"a":{"x":"6"}}]]', '{"a":%s,"A":[{"x":"5"}]}']
    inner = ['{"x":"1","b":{"c":{"y":"2"}}}', '[{"x":"1","b":{"c":[{"y":"2"},{"y":3}]}},{"x":{"z":"1"}},null,"t"]', '[]', 'null', '"t"', '[[{"x":"1"}]]',
             '{"x":"1","b":[{"c":{"y":"2"}}]}', '{"x":["1"],"b":{"c":null}}', '{"X":"1","b":{"c":[{"Y":"3"}]}}']
    texts = [s % i for s, i in itertools.product(shapes, inner)] + ["[]", "null", "4", "{}", None, '{"a":{"b":"u"}}']
    df = bronze([("e", t, None, f"s_{i}") for i, t in enumerate(texts)])
    context = {"ingested_from": F.col("ingested_from")}

    def tables(hand_down):
        leaf = Node(table="leaf", path=("b", "c"), fields=(Field("y", "y"),))
        below = Node(table="below", path=("a",), fields=(Field("x", "x"),), hand_down=(Field("x", "x"),), children=(leaf,))
        whole = Node(table="whole", path=("a",), fields=(Field("x", "x"),), text_element="v")
        filled = Node(table="filled", path=("a",), fields=(Field("x", "x"), Field("X", "x2")), require="filled")
        return build_tables(df, (Root(element="e", hand_down=hand_down, children=(below, whole, filled)),), context)

    hops, direct = tables((Field("none", "none"),)), tables(())
    assert hops.keys() == direct.keys() == {"leaf", "below", "whole", "filled"}
    for name, table in direct.items():
        expected = rows(hops[name].drop("none"))
        assert rows(table) == expected and len(expected) > 15, name
    assert [direct[t]._jdf.queryExecution().executedPlan().toString().count("Generate ") for t in ("below", "leaf")] == [1, 2]


def test_the_table_of_a_root_needs_its_own_tree_only(bronze):
    from payloom.plans.catalog import pipeline
    from payloom.plans.tables import pipeline_tables, plan_shapes

    events = pipeline("matchstatsandevents")
    # Event flows without a game id have no key: their own table can't be made, that of the statistics can.
    df = bronze([("gameStats", '[{"gameId":"7","gameState":"f"}]'), ("eventFlow", '{"roundId":"3"}')])
    assert rows(pipeline_tables(events, df, only=("gamestats",))["gamestats"], "game_id", "game_state") == [("7", "f")]
    with pytest.raises(ValueError):
        pipeline_tables(events, df, only=("eventflow",))
    tree, _ = plan_shapes(pipeline("matchdata"), bronze([("teams", '{"game_id":"1","teamsMatch":[{"team_id":"2"}]}'), ("gameInfo", '{"city":"x"}')]), only=("teams_match",))
    assert [r.element for r in tree.roots] == ["gameInfo", "teams"]
