import datetime
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payloom.functions.text import audit_key, id_part, snake_case, snake_case_column, split_table_name
from payloom.functions.variant import as_list, get, text_node, vpath
from payloom.operators import keys as K
from payloom.operators import quality as Q
from payloom.operators import reshape as R
from payloom.operators.entities import build_tables
from payloom.operators.scd import fallback, known_steps, late_steps, scd1, scd2, scd2_steps, scd2_versions, surrogate_key
from payloom.operators.schema import infer_schema, profile_paths
from payloom.plans import checks as C
from payloom.plans.spec import Field, Root


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@given(st.text(alphabet="aZ09bYcX_", max_size=20))
@settings(max_examples=200, deadline=None)
def test_snake_case_is_lower_and_keeps_letters(name):
    out = snake_case(name)
    assert out == out.lower()
    assert out.replace("_", "") == name.replace("_", "").lower()
    assert not re.search(r"[a-z0-9][A-Z]", out)


def test_snake_case_examples_and_column_version(spark):
    names = {"teamID": "team_id", "gameHashTag": "game_hash_tag", "startTimeUTC": "start_time_utc",
             "URLCode": "url_code", "team1stHalfScore": "team1st_half_score", "ID": "id", "xandYFeed1stHalf": "xand_y_feed1st_half"}
    assert {n: snake_case(n) for n in names} == names
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert dict(df.select("n", snake_case_column("n")).collect()) == names


def test_paths_and_table_names():
    assert vpath("a.b", 0, 'q"x') == "$[\"a.b\"][0]['q\"x']"
    assert split_table_name("c.s.t") == ("s", "t") and split_table_name("t") == ("", "t")
    with pytest.raises(ValueError):
        vpath("a'\"b")


def test_id_part_short_ids_and_audit_key(spark):
    df = spark.createDataFrame([("a_1_2024",), ("a_1",), (None,)], "s string")
    assert rows(df, id_part("s", 2), id_part("s", -1), id_part("s", -1, at_least=3)) == sorted(
        [("2024", "2024", "2024"), (None, "1", None), (None, None, None)], key=repr)
    assert df.select(audit_key("x", "", "5")).first()[0] == "x_5"


@given(st.lists(st.integers(0, 3), max_size=4))
@settings(max_examples=10, deadline=None)
def test_list_and_bare_object_read_the_same(spark, values):
    import json

    shapes = [json.dumps({"v": [{"n": n} for n in values]})]
    if len(values) == 1:
        shapes.append(json.dumps({"v": {"n": values[0]}}))
    df = spark.createDataFrame([(s,) for s in shapes], "s string").select(F.parse_json("s").alias("v"))
    out = df.select(F.transform(as_list("v", "v"), lambda x: get(x, "n", as_type="int")).alias("n")).collect()
    assert all(r["n"] == values for r in out)


def test_text_node_forms(spark):
    df = spark.createDataFrame([('"FB"',), ('{"#text":"FB"}',), ('{"_text":"FB"}',), ('{"text":"FB"}',), ("null",), ("{}",)],
                               "s string").select(text_node(F.parse_json("s")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["FB"] * 4 + [None] * 2


def test_infer_schema_over_mixed_shapes(spark):
    df = spark.createDataFrame([('{"t":{"x":1}}',), ('{"t":[{"x":2,"y":"s"}]}',)], "s string").select(F.parse_json("s").alias("v"))
    assert infer_schema(df, "v", "t").simpleString() == "struct<x:bigint,y:string>"


def test_profile_of_nulls_and_mixed_paths(spark):
    df = spark.createDataFrame([('{"a":[1,null]}',), ('{"a":{"b":null}}',), (None,)], "s string").select(
        F.try_parse_json("s").alias("v"))
    assert rows(profile_paths(df, "v")) == sorted([
        ("$", "object", 2, 0), ("$.a", "array", 1, 0), ("$.a", "object", 1, 0), ("$.a[]", "scalar", 1, 0),
        ("$.a[]", "null", 1, 1), ("$.a.b", "null", 1, 1)], key=repr)


def test_profile_opens_all_levels_or_says_so(spark):
    df = spark.createDataFrame([('{"a":[[{"b":{"c":[1]}}]],"s":"]]]][[[\\"{{"}',)], "s string").select(F.try_parse_json("s").alias("v"))
    paths = {r["path"] for r in profile_paths(df, "v").collect()}
    assert "$.a[][].b.c[]" in paths
    assert {r["path"] for r in profile_paths(df, "v", 6).collect()} == paths
    with pytest.raises(Exception, match="deeper than 3"):
        profile_paths(df, "v", 3).collect()


def test_profile_of_long_texts_many_levels_and_odd_names(spark):
    deep = "".join(f'{{"l{k}":[' for k in range(20)) + "1" + "]}" * 20
    texts = ['{"s":"' + "x\\\"" * 400_000 + '"}', deep, '{"a.b":1,"a":{"b":2},"q\\"]":3,"\\\\":4,"É9":5,"9":6}']
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(F.parse_json("s").alias("v"))
    found = {r["path"]: r["n_rows"] for r in profile_paths(df, "v").collect()}
    assert "$" + "".join(f".l{k}[]" for k in range(20)) in found
    assert {p: n for p, n in found.items() if not p.startswith("$.l") and p != "$"} == {
        "$.s": 1, '$["a.b"]': 1, "$.a": 1, "$.a.b": 1, '$["q\\"]"]': 1, '$["\\\\"]': 1, "$.É9": 1, '$["9"]': 1}


def test_surrogate_keys_depend_on_no_zone_and_no_separator(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a|b', 'c', 0), ('a', 'b|c', 0), ('1:a', '', 0), ('1', 'a', 0), (NULL, '-', 0), ('-', NULL, 0), ('x', 'y', 1604208600), ('x', 'y', 1604212200) AS t(k, l, s)""")
    df = df.selectExpr("k", "l", "timestamp_seconds(s) AS at", "timestampadd(SECOND, s, timestamp_ntz'1970-01-01') AS wall")
    found = {}
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found[zone] = [tuple(r) for r in df.select(surrogate_key(["k", "l"], "at"), surrogate_key(["k", "l"], "wall", zoned=False)).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found["UTC"] == found["America/New_York"] and all(a == b for a, b in found["UTC"])
    assert len({a for a, _ in found["UTC"]}) == 8


def test_carry_forward_keeps_rows_without_key_or_time(spark):
    from payloom.operators.scd import carry_forward

    df = spark.sql("""SELECT * FROM VALUES ('a', timestamp'2023-01-01', 1), ('a', timestamp'2024-01-01', NULL), (NULL, timestamp'2024-01-01', 5), (NULL, timestamp'2025-01-01', NULL),
                      ('a', NULL, NULL), ('a', NULL, 7) AS t(k, at, v)""")
    got = sorted((tuple(r) for r in carry_forward(df, ["k"], ["v"], "at").selectExpr("k", "year(at)", "v").collect()), key=repr)
    assert got == sorted([("a", 2023, 1), ("a", 2024, 1), (None, 2024, 5), (None, 2025, 5), ("a", None, None), ("a", None, 7)], key=repr)


def test_checks_fail_one_by_one_also_at_run_time(spark):
    df = spark.range(3)
    found = Q.run_checks(spark, {
        "ok": lambda: Q.expect_rows(df, "ok"), "late": lambda: Q.expect_none(df.filter("raise_error('x') IS NULL"), "late"),
        "early": lambda: Q.expect_unique(df, ["nope"], "early"), "bad": lambda: Q.expect_none(df, "bad")})
    assert rows(found) == [("bad", "FAIL", 3), ("early", "ERROR", None), ("late", "ERROR", None), ("ok", "PASS", 0)]


def test_steps_back_across_chunks(spark):
    times = [("k", "2024-01-31 10:00:00", 5), ("k", "2024-02-01 10:00:00", 5), ("k", "2024-02-02 10:00:00", 7), ("k", "2024-04-01 00:00:00", 6), ("k", "2024-05-01 00:00:00", 8),
             ("other", "2024-02-01 00:00:00", 1)]
    df = spark.createDataFrame(times, "config_name string, at string, ingested_at int").selectExpr("config_name", "to_timestamp(at) AS flattened_at", "ingested_at")
    assert rows(Q.steps_back(df), "ingested_at") == [(5,), (6,)]


def test_inlined_names_keep_values(bronze):
    node = Root(table="t", element="o", fields=(Field("id", "id"), Field("v", "v")), inline=((("a",), "", (Field("v", "v"), Field("w", "w"))), (("b",), "", (Field("w", "w"),))))
    df = bronze([("o", '{"id":1,"v":"own","a":{"w":"a"},"b":{"w":"b"}}'), ("o", '{"id":2,"v":"own","a":{"v":"inner","w":"a"}}'), ("o", '{"id":3}')])
    out = build_tables(df, (node,), {})["t"]
    assert rows(out, "id", "v", "w") == [("1", "own", "b"), ("2", "inner", "a"), ("3", None, None)]


def test_surrogate_keys_tell_microseconds_and_missing_parts(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', CAST(NULL AS string), timestamp'2024-01-01 00:00:00.000001'), (NULL, 'a', timestamp'2024-01-01 00:00:00.000001'), "
                   "('a', '', timestamp'2024-01-01 00:00:00.000001'), ('a', NULL, timestamp'2024-01-01 00:00:00.000002') AS t(k, l, at)")
    assert df.select(surrogate_key(["k", "l"], "at")).distinct().count() == 4


def test_latest_is_deterministic_on_full_ties(spark):
    data = [("k", "2024-01-01", "a", i) for i in range(20)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, ingested_at string, ingested_from string, v int").repartition(4)
        seen.add(K.latest(df, ["k"]).first()["v"])
    assert len(seen) == 1
    with pytest.raises(ValueError, match="nope"):
        K.latest(df, ["nope"])


def test_merge_rows_takes_last_non_null_per_column(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "x"), (1, 3, "b", None)], "k int, at int, p string, q string")
    assert rows(K.merge_rows(df, ["k"], ["at"], ["p", "q"])) == [(1, "b", "x")]


def test_numbered_keys_with_gaps_and_max(spark):
    df = spark.createDataFrame([(1, '[{"recentForm1":{"_text":"W"},"recentForm2":{"_text":"L"},"recentForm10":{"_text":"D"},"recentFormX":{"_text":"no"}}]'),
                                (2, '{}'), (3, None)], "id int, s string").select("id", F.try_parse_json("s").alias("p"))
    out = R.unpivot_numbered(df, "p", "recentForm", ("_text",), "form_order", "result")
    assert rows(out) == [(1, 1, "W"), (1, 10, "D"), (1, 2, "L")]
    assert R.max_number(df, "p", "recentForm").first()[0] == 10
    assert R.max_number(df, "p", "other").first()[0] == 0
    far = spark.sql("""SELECT 1 AS id, parse_json('[{"recentForm99999999999":{"_text":"W"},"recentForm99999999999999999999":{"_text":"L"}}]') AS p""")
    assert rows(R.unpivot_numbered(far, "p", "recentForm", ("_text",), "form_order", "result")) == [(1, 99999999999, "W"), (1, None, "L")]


def test_text_columns_write_json_text(spark):
    df = spark.sql("SELECT true AS b, parse_json('{\"z\":1,\"a\":[1]}') AS v, named_struct('x', 1) AS s, 1.50 AS d")
    assert rows(R.text_columns(df)) == [("true", '{"a":[1],"z":1}', '{"x":1}', "1.50")]


def _versions(events):
    """Brute force SCD2 over (key, ts, value)."""
    out = []
    for key in {k for k, _, _ in events}:
        mine = sorted({t: v for k, t, v in sorted(events, key=lambda e: (e[1], -e[2])) if k == key}.items())
        changes = [(t, v) for i, (t, v) in enumerate(mine) if i == 0 or v != mine[i - 1][1]]
        for i, (t, v) in enumerate(changes):
            out.append((key, v, t, changes[i + 1][0] if i + 1 < len(changes) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", ["hour", "day", "year"])
def test_scd2_equals_brute_force_for_any_chunk(spark, chunk):
    rnd = random.Random(7)
    # Key 0 holds most rows; values repeat for long stretches across chunk borders.
    events = [(0 if rnd.random() < 0.6 else rnd.randint(1, 4), rnd.randint(0, 2_000_000), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(events, "k int, t long, v int").withColumn("ts", F.timestamp_seconds("t"))
    out = scd2(df, ["k"], ["v"], "ts", order=["v"], chunk=chunk)
    mine = [(r["k"], r["v"], int(r["f"]), None if r["u"] is None else int(r["u"])) for r in out.select(
        "k", "v", F.unix_timestamp("valid_from").alias("f"), F.unix_timestamp("valid_to").alias("u")).collect()]
    assert sorted(mine, key=repr) == _versions(events)
    assert out.filter("is_current").count() == len({k for k, _, _ in events})


@pytest.mark.parametrize("chunk", ["hour", "year"])
def test_late_steps_in_any_order_of_loads_equal_one_build(spark, tmp_path, chunk):
    rnd = random.Random(11)
    events = [(0 if rnd.random() < 0.6 else rnd.randint(1, 4), rnd.randint(0, 60_000), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame([(*e, rnd.randint(0, 2)) for e in events], "k int, t long, v int, load int")
    df = df.withColumn("ts", F.timestamp_seconds("t"))
    args = (["k"], ["v"], "ts", ["v"], chunk)
    # The second load comes twice, and an empty one at the end.
    steps, seen = scd2_steps(df.filter("load = 2"), *args), ["load = 2"]
    for i, load in enumerate(["load = 0", "load = 0", "load = 1", "false"]):
        seen.append(load)
        late_steps(df.filter(" OR ".join(seen)), df.filter(load), steps, *args).write.parquet(f"{tmp_path}/{i}")
        steps = spark.read.parquet(f"{tmp_path}/{i}")
    out = scd2_versions(steps, ["k"], ["v"])
    mine = [(r["k"], r["v"], int(r["f"]), None if r["u"] is None else int(r["u"])) for r in out.select(
        "k", "v", F.unix_timestamp("valid_from").alias("f"), F.unix_timestamp("valid_to").alias("u")).collect()]
    assert sorted(mine, key=repr) == _versions(events)


def test_late_steps_leave_other_chunks_alone(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp'2024-01-01', 'a'), (1, timestamp'2024-02-01', 'a'), (1, timestamp'2024-03-01', 'a'),
        (null, timestamp'2024-01-05', 'z') AS t(k, ts, v)""")
    steps = scd2_steps(df, ["k"], ["v"], "ts", chunk="month")
    late = spark.sql("SELECT 1 AS k, timestamp'2024-02-03' AS ts, 'b' AS v UNION ALL SELECT null, timestamp'2024-01-01', 'z' UNION ALL SELECT 1, null, 'c'")
    # The rows of untouched chunks are not given at all: their steps are the stored ones.
    near = df.filter("k IS NULL OR month(ts) = 2").unionByName(late)
    out = scd2_versions(late_steps(near, late, steps, ["k"], ["v"], "ts", chunk="month"), ["k"], ["v"])
    assert [(r["k"], r["v"], str(r["valid_from"])[:10], str(r["valid_to"])[:10]) for r in out.orderBy("k", "valid_from").collect()] == [
        (None, "z", "2024-01-01", "None"), (1, "a", "2024-01-01", "2024-02-03"), (1, "b", "2024-02-03", "2024-03-01"), (1, "a", "2024-03-01", "None")]


def test_late_load_of_a_dimension_keeps_times_of_unchanged_versions(spark):
    from payloom.plans.dimensions import DIMENSIONS, build_dimension

    ddl = "coachId string, season_id string, teamId string, role string, ingested_at timestamp"

    def load(*rows):
        return {"season_list_coach": spark.createDataFrame(
            [(k, "2024", t, "Head", datetime.datetime(2024, 1, d)) for k, t, d in rows], ddl)}

    def stamp(d):
        return F.lit(datetime.datetime(2024, 2, d))

    dim = DIMENSIONS["dim_coach"]
    first = (("1", "x", 1), ("1", "y", 9), ("2", "x", 1))
    late = (("1", "z", 5), ("1", "y", 7))
    stored = build_dimension(dim, load(*first), stamp(1))
    out = build_dimension(dim, load(*late), stamp(2), existing=stored, history=load(*first, *late))
    got = out.selectExpr("coach_id", "team_id", "day(valid_from)", "day(valid_to)", "day(_loaded_at)", "day(_updated_at)").collect()
    # x of coach 1 ends earlier, y starts earlier (a version of its own), coach 2 is as stored.
    assert sorted(map(tuple, got), key=repr) == [
        ("1", "x", 1, 5, 1, 2), ("1", "y", 7, None, 2, 2), ("1", "z", 5, 7, 2, 2), ("2", "x", 1, None, 1, 1)]


@pytest.mark.parametrize("chunk", ["hour", "year"])
def test_known_steps_give_the_versions_of_filled_rows(spark, chunk):
    rnd = random.Random(5)
    some = [(0 if rnd.random() < 0.6 else rnd.randint(1, 4), rnd.randint(0, 40_000), rnd.choice([None, None, 0, 1]), rnd.choice([None, 5, 6]), rnd.randint(1, 2))
            for _ in range(400)]
    # One row per key, time and rank: what ties come to is a matter of hashes.
    events = list({(k, t, r): (k, t, v, w, r) for k, t, v, w, r in some}.values()) + [(None, 10, None, 5, 1), (None, 20, 1, None, 1)]
    df = spark.createDataFrame(events, "k int, t long, v int, w int, r int").withColumn("ts", F.timestamp_seconds("t"))
    steps = known_steps(df, ["k"], ["v", "w"], "ts", [F.col("r").desc()], chunk)
    out = scd2(steps, ["k"], ["v", "w"], "ts", chunk=chunk).selectExpr("k", "v", "w", "unix_timestamp(valid_from)", "unix_timestamp(valid_to)")
    want = []
    for key in {e[0] for e in events}:
        state, changes = {}, []
        for t in sorted({e[1] for e in events if e[0] == key}):
            for _, _, v, w, _ in sorted((e for e in events if e[0] == key and e[1] == t), key=lambda e: -e[4]):
                state.update({c: x for c, x in (("v", v), ("w", w)) if x is not None})
            now = (state.get("v"), state.get("w"))
            if not changes or changes[-1][0] != now:
                changes.append((now, t))
        want += [(key, *s, t, changes[i + 1][1] if i + 1 < len(changes) else None) for i, (s, t) in enumerate(changes)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_scd2_null_values_and_null_key(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp'2024-01-01', CAST(null AS string)), (1, timestamp'2024-01-02', null),
        (1, timestamp'2024-02-03', 'a'), (null, timestamp'2024-01-01', 'z'), (1, null, 'x') AS t(k, ts, v)""")
    out = scd2(df, ["k"], ["v"], "ts")
    assert [(r["k"], r["v"], str(r["valid_from"])[:10], r["is_current"]) for r in out.orderBy("k", "valid_from").collect()] == [
        (None, "z", "2024-01-01", True), (1, None, "2024-01-01", False), (1, "a", "2024-02-03", True)]


def test_scd1_keeps_first_load_time(spark):
    ddl = "k int, v string, at int, _source_table string, _loaded_at int, _updated_at int"
    old = spark.createDataFrame([(1, "a", 1, "s", 10, 10), (2, "b", 1, "s", 10, 10)], ddl)
    new = spark.createDataFrame([(1, "c", 2, "s", 20, 20), (3, "d", 2, "s", 20, 20)], ddl)
    assert rows(scd1(new, ["k"], ["at"], existing=old), "k", "v", "_loaded_at", "_updated_at") == [
        (1, "c", 10, 20), (2, "b", 10, 10), (3, "d", 20, 20)]


def test_fallback_only_fills_missing_keys(spark):
    a = spark.createDataFrame([(1, "p")], "k int, v string")
    b = spark.createDataFrame([(1, "s"), (2, "s")], "k int, v string")
    assert rows(fallback(a, b, ["k"])) == [(1, "p"), (2, "s")]


def test_checks_pass_fail_and_error(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    results = Q.run_checks(spark, {
        "u": lambda: Q.expect_unique(df, ["k"], "u"),
        "n": lambda: Q.expect_not_null(df, ["k", "v"], "n"),
        "e": lambda: Q.expect_rows(spark.table("missing_table"), "e"),
        "r": lambda: Q.expect_rows(df.filter("k = 9"), "r"),
    })
    assert rows(results) == [("e", "ERROR", None), ("n:k", "PASS", 0), ("n:v", "FAIL", 1), ("r", "FAIL", 1), ("u", "FAIL", 1)]
    assert rows(Q.summarize(results)) == [("ERROR", 1), ("FAIL", 3), ("PASS", 1)]
    with pytest.raises(AssertionError, match="n:v FAIL"):
        Q.assert_passed(results)
    Q.assert_passed(results.filter("status = 'PASS'"))


def test_rules_of_a_table_take_one_scan(spark):
    data = [(1, "a", None), (1, "a", 3), (2, None, 3), (None, "b", 3), (None, None, 4), (3, "c", 4)]
    df = spark.createDataFrame(data, "k int, `v.w` string, x int")
    rules = Q.TableRules(("k", "v.w"), ("k", "v.w", "x"), ((("k",), 2), (("x",), 3)), where=F.expr("x = 4"))
    alone = [r for make in Q.rule_checks(lambda: df.withColumnRenamed("v.w", "v"), "t", Q.TableRules(("k", "v"), ("k", "v", "x"), rules.exactly, where=rules.where)).values()
             for r in rows(make())]
    got = Q.check_table(df, "t", rules)
    assert rows(got) == sorted((c.replace("t:v", "t:v.w") if c == "t:v" else c, *r) for c, *r in alone)
    assert rows(got) == [("t:2 rows", "FAIL", 2), ("t:3 rows", "FAIL", 2), ("t:k", "FAIL", 2), ("t:rows", "PASS", 0), ("t:unique", "FAIL", 1),
                         ("t:v.w", "FAIL", 2), ("t:x", "FAIL", 1)]
    for none in (df.limit(0), df.filter("x = 9")):
        assert {r.check_id: r.bad_rows for r in Q.check_table(none, "t", rules).collect()} == {
            "t:rows": 1, "t:unique": 0, "t:k": 0, "t:v.w": 0, "t:x": 0, "t:2 rows": 0, "t:3 rows": 0}
    lacking = Q.check_table(df, "t", Q.TableRules(("k", "nope"), ("k", "nope"), where=F.expr("x > 9")))
    assert rows(lacking) == [("t:k", "FAIL", 2), ("t:nope", "ERROR", None), ("t:rows", "FAIL", 1), ("t:unique", "ERROR", None)]


def test_jobs_of_a_plan(spark, tmp_path):
    """One query a table however many rules it has, one by one only where the scan breaks."""
    spark.range(100).selectExpr("id AS game_id", "id % 7 AS team_id", "'s' AS ingested_from").write.parquet(str(tmp_path / "t"))
    made = []

    def table(columns=("*",)):
        made.append(1)
        return spark.read.parquet(str(tmp_path / "t")).selectExpr(*columns)

    rules = Q.TableRules(("game_id", "team_id"), ("game_id", "team_id", "ingested_from"), ((("game_id",), 1), (("team_id",), 2)))
    got = Q.run_checks(spark, {"t": Q.table_rules(table, "t", rules)})
    assert len(made) == 1 and rows(got.groupBy("status").count()) == [("FAIL", 1), ("PASS", 6)]
    plan = Q.check_table(table(), "t", rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("Expand") == 1
    broken = lambda: table(("game_id", "raise_error('x') AS team_id", "ingested_from"))
    got = dict(r[:2] for r in rows(Q.run_checks(spark, {"t": Q.table_rules(broken, "t", rules)})))
    assert {c for c, status in got.items() if status == "PASS"} == {"t:rows", "t:game_id", "t:ingested_from", "t:1 rows"} and len(got) == 7


def test_plan_of_a_pipeline_reads_each_table_once(spark):
    reads = []

    class Counted(dict):
        def __getitem__(self, table):
            reads.append(table)
            return super().__getitem__(table)

    df = spark.createDataFrame([(1, 2, 3, "s")], "game_id int, team_id int, player_id int, ingested_from string").withColumn("coach_id", F.lit(9))
    tables = Counted({t: df for t in C.KEYS["matchdata"]})
    got = Q.run_checks(spark, C.table_checks("matchdata", tables))
    # One read a table, and both sides of the one rule between two.
    assert sorted(reads) == sorted([*C.KEYS["matchdata"], "teams_match", "gameinfo"])
    assert [r for r in rows(got) if r[1] != "PASS"] == [("matchdata.teams_match:2 rows", "FAIL", 1)]
    assert got.count() == 2 * 5 + sum(map(len, C.KEYS["matchdata"].values())) + 2


def test_rules_between_tables_read_each_table_once(spark, tmp_path):
    import random

    random.seed(7)

    def frame(n, ddl="g string, t int, p int, x int", keys=6):
        pick = lambda k: random.choice([None, *range(k)])
        return spark.createDataFrame([(None if (g := pick(keys)) is None else f"g{g}", pick(3), pick(2), pick(2)) for _ in range(n)], ddl)

    def check(tables, matches, fused=True):
        alone = [r for name, (df, rules) in tables.items() for make in Q.rule_checks(lambda df=df: df, name, rules).values() for r in rows(make())]
        alone += [r for m in matches for r in rows(Q.expect_parent(m.left, m.right, m.on, m.check_id))]
        assert rows(Q.check_related(tables, matches)) == sorted(alone, key=str) and (Q._common_key(tables, matches) is not None) is fused

    one = Q.TableRules(("g",), ("g", "x"), ((("g",), 2),), where=F.expr("x = 1"))
    two = Q.TableRules(("G", "t"), ("g", "t"), ((("g",), 2), (("t", "g"), 1)))
    deep = Q.TableRules(("g", "t", "p"), ("p",), ((("g", "t"), 1),), rows=False)
    for n in (0, 30):
        a, b, c = frame(n), frame(2 * n), frame(3 * n, keys=9)
        check({"a": (a, one), "b": (b, two)}, [Q.Match("b:in a", b, a, ("g",))])
        check({"a": (a, one), "c": (c, deep), "b": (b, two)}, [Q.Match("c:in b", c, b, ("g",)), Q.Match("a:has c", a, c, ("G",))])
        check({"b": (b, two), "c": (c, deep)}, [Q.Match("c:in b", c, b, ("t", "g"))], fused=False)
        check({"b": (b, two._replace(exactly=())), "c": (c, deep)}, [Q.Match("c:in b", c, b, ("t", "g"))])
        check({"b": (b, Q.TableRules()), "c": (c, Q.TableRules(("p",)))}, [Q.Match("c:in b", c, b, ("g",))], fused=False)
        check({"b": (b, two), "d": (b, one)}, [Q.Match("b:in b", b, b, ("g",))])
    spark.range(20).selectExpr("id % 9 AS game_id", "id AS team_id", "'s' AS ingested_from", "id AS coach_id", "id AS player_id").write.parquet(str(tmp_path / "t"))
    tables = {t: spark.read.parquet(str(tmp_path / "t")) for t in C.KEYS["matchdata"]}
    related, *others = C.table_checks("matchdata", tables).values()
    plan = related.make()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "Join" not in plan and "Expand" not in plan and len(others) == 3 and len(related.apart) == 3
    # Numbers and texts are matched as a join does it, and a table that is missing leaves the others alone.
    tables["gameinfo"] = tables["gameinfo"].withColumn("game_id", F.expr("CAST(game_id % 5 AS string)"))
    wrong = {"matchdata.gameinfo:unique": 5, "matchdata.teams_match:2 rows": 2, "matchdata.teams:unique": 9, "matchdata.teams_match:in gameinfo": 8}
    assert {r[0]: r[2] for r in rows(Q.run_checks(spark, C.table_checks("matchdata", tables))) if r[1] == "FAIL"} == wrong
    del tables["gameinfo"]
    got = Q.run_checks(spark, C.table_checks("matchdata", tables))
    assert {r[0] for r in rows(got) if r[1] == "ERROR"} == {f"matchdata.{c}" for c in ("gameinfo:rows", "gameinfo:unique", "gameinfo:game_id", "teams_match:in gameinfo")}


def test_choices_made_outside_of_a_payload_build_it_once(spark):
    from payloom.suite.base import Either, Repeat, chosen_first, variant_sql

    odd, third = "id % 2 = 1", "id % 3 = 0"
    entry = {"n": "CAST(i AS string)"}
    t = {"a": Either("false", [], Either(odd, {"x": "'1'"}, [{"x": "'1'"}, {"x": "'2'"}])), "b": {"c": [Either(odd, "'p'", {"q": "'r'"})]},
         "d": Either(third, {}, {"e": Either(odd, "'o'", Either(third, "'never'", "'z'"))}), "f": Repeat("id", entry), "g": None}
    outside = variant_sql(chosen_first({"a": t["a"], "b": {"c": Either(odd, "'p'", {"q": "'r'"})}}))
    assert variant_sql({"a": t["a"]}).count("CASE") == 2 and outside.count("CASE") == 1 and outside.count("to_variant_object") == 2
    ids = "CASE WHEN id = 6 THEN NULL ELSE id END AS id"
    for template in (t, Either(third, t, [t]), [t], Either(odd, Either(odd, "'1'", "'2'"), "'3'")):
        for most in (0, 1, 2):
            got = spark.range(7).selectExpr(ids).selectExpr(f"CAST({variant_sql(chosen_first(template, most))} AS string) AS a", f"CAST({variant_sql(template)} AS string) AS b")
            assert all(r.a == r.b and r.a for r in got.collect())
