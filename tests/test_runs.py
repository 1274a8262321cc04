import dataclasses
from decimal import Decimal
import json
from datetime import datetime

import pytest

from payloom.plans import incremental as I
from payloom.plans.catalog import PIPELINES, pipeline
from payloom.plans.dimensions import DIMENSIONS, create_dimension_tables
from payloom.plans.spec import Field, Root
from payloom.plans.tables import pipeline_tables, plan_shapes
from payloom.sinks import logs
from payloom.sinks.tables import LINEAGE, drop_tables, write_table
from payloom.sources.bronze import read_bronze, scope_filter, window_filter
from payloom.streaming import drop_repeats, run_available


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def coach(i, name):
    return json.dumps([{"teamId": str(i), "teamName": f"T{i}", "coaches": {"coach": {"coachId": f"c{i}", "fullName": name}}}])


@pytest.fixture()
def coaches(spark, bronze):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_stats")
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_stats_flatten")
    names = ["bronze_stats.coaches", "bronze_stats_flatten.coaches", "bronze_stats_flatten.coaches_coach",
             "run_audit", "run_errors"]
    drop_tables(spark, names)
    logs.create_logs(spark, "run_audit", "run_errors")

    def load(*entries):
        df = bronze([("teams", coach(i, n), '{"competitionName":"League"}', f"coaches_{c}_2024", at) for c, i, n, at in entries])
        df.write.format("parquet").mode("append").saveAsTable("bronze_stats.coaches")

    yield load
    drop_tables(spark, names)


def test_two_windows_append_once_each_and_nothing_is_due_after(spark, coaches):
    coaches(("111", 1, "Ann", "2024-01-01 00:00:00"), ("1119", 9, "Other", "2024-01-05 00:00:00"))
    pipe = pipeline("coaches")
    due = I.discover_runs(spark, [pipe], "run_audit", ["111"], ["2024"])
    assert [(r.key, r.low, r.high) for r in due] == [("coaches_111_2024", None, datetime(2024, 1, 1))]
    assert I.run_all(spark, due, "run_audit", "run_errors") == {
        "coaches_111_2024": {"bronze_stats_flatten.coaches": 1, "bronze_stats_flatten.coaches_coach": 1}}
    assert I.discover_runs(spark, [pipe], "run_audit", ["111"], ["2024"]) == []

    coaches(("111", 2, "Bea", "2024-02-01 00:00:00"))
    due = I.discover_runs(spark, [pipe], "run_audit", ["111"], ["2024"])
    assert (due[0].low, due[0].high) == (datetime(2024, 1, 1), datetime(2024, 2, 1))
    I.run_all(spark, due, "run_audit", "run_errors", staged=True)
    out = spark.table("bronze_stats_flatten.coaches_coach")
    assert rows(out, "coach_id", "full_name", "team_id", "competition_id", *LINEAGE) == [
        (f"c{i}", n, str(i), "111", "bronze_stats", "coaches", "bronze_stats_flatten", "coaches_coach")
        for i, n in ((1, "Ann"), (2, "Bea"))]
    assert spark.table("run_audit").count() == 2 and spark.table("run_errors").count() == 0


def test_failed_run_is_logged_and_does_not_stop_others(spark, coaches):
    coaches(("111", 1, "Ann", "2024-01-01 00:00:00"))
    good, bad = I.Run(pipeline("coaches"), {"competition_id": "111", "season": "2024"}), I.Run(pipeline("ladder"), {})
    with pytest.raises(RuntimeError, match="1 of 2 runs failed: ladder"):
        I.run_all(spark, [bad, good], "run_audit", "run_errors")
    assert rows(spark.table("run_errors"), "pipeline_step") == [("ladder",)]
    assert "does not exist" in spark.table("run_errors").first()["error_traceback"]
    assert rows(spark.table("run_audit"), "config_name") == [("coaches_111_2024",)]
    with pytest.raises(RuntimeError, match="1 of 1 runs failed"):
        I.run_all(spark, [I.Run(pipeline("coaches"), {"competition_id": "111"})], "run_audit", "run_errors")
    assert "lacks season" in spark.table("run_errors").filter("pipeline_step = 'coaches_111'").first()["error_message"]


def test_unreadable_source_stops_discovery(spark, coaches):
    with pytest.raises(RuntimeError, match="ladder"):
        I.discover_runs(spark, [pipeline("ladder")], "run_audit", ["111"], ["2024"], errors="run_errors")
    assert rows(spark.table("run_errors"), "pipeline_step") == [("ladder",)]


def test_parameters_keys_and_grid(spark):
    assert I.combinations(pipeline("entities"), [], []) == [{}]
    assert I.combinations(pipeline("coaches"), ["1"], []) == []
    assert I.combinations(pipeline("season_list"), ["1", "2"], []) == [{"competition_id": "1"}, {"competition_id": "2"}]
    assert I.key_of("x", {"competition_id": "1", "season": "2024"}) == "x_1_2024"
    assert rows(I.param_grid(spark, "111, 105,", "2024,2025")) == sorted(
        [(c, s) for c in ("111", "105") for s in ("2024", "2025")], key=repr)
    assert rows(I.param_grid(spark, "111", "")) == [("111", "")]


def test_scope_is_literal_and_by_whole_parts(spark):
    df = spark.createDataFrame([(s,) for s in ("x_11", "x_11_2024", "x_111", "x_11_2024_5", "xa11_2024")], "ingested_from string")
    assert rows(df.filter(scope_filter("x_{competition_id}", {"competition_id": "11"}))) == [("x_11",), ("x_11_2024",), ("x_11_2024_5",)]
    assert rows(df.filter(scope_filter("x_{competition_id}_{season}", {"competition_id": "11", "season": "2024"}, True))) == [("x_11_2024",)]
    assert scope_filter("x_{competition_id}_{season}", {}) is None
    with pytest.raises(ValueError, match="lacks season"):
        scope_filter("x_{competition_id}_{season}", {"competition_id": "11"})
    assert window_filter(None, None) is None


def test_scope_and_window_reach_the_scan(spark, coaches):
    coaches(("111", 1, "Ann", "2024-01-01 00:00:00"))
    df = read_bronze(spark, "bronze_stats.coaches", scope_filter("coaches_{competition_id}_{season}", {
        "competition_id": "111", "season": "2024"}), window_filter("2023-01-01", "2024-06-01"))
    plan = df.select("ingested_from")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(" in plan.split("PushedFilters")[1]
    assert "variant" not in plan.split("ReadSchema")[1]


def test_append_adds_new_columns_and_empty_tables_exist(spark):
    drop_tables(spark, ["grow", "bare"])
    assert write_table(spark.sql("SELECT 1 AS a"), "grow", source="s.b") == 1
    assert write_table(spark.sql("SELECT 'x' AS extra, 2 AS a"), "grow", source="s.b") == 1
    assert rows(spark.table("grow"), "a", "extra") == [(1, None), (2, "x")]
    assert write_table(spark.sql("SELECT 1 AS a WHERE false"), "bare") == 0
    assert spark.table("bare").columns == ["a", *LINEAGE]
    drop_tables(spark, ["grow", "bare"])


@pytest.mark.parametrize("declared", [True, False])
def test_stream_equals_batch_and_picks_up_only_new_files(spark, bronze, tmp_path, declared):
    pipe = dataclasses.replace(pipeline("coaches"), prefix=f"stream_coaches_{int(declared)}")
    src, cp = (str(tmp_path / n) for n in ("src", "cp"))
    spark.sql("DROP TABLE IF EXISTS stream_audit")
    logs.create_logs(spark, "stream_audit", "stream_errors")
    first = bronze([("teams", coach(1, "Ann"), None, "coaches_1_2024", "2024-01-01 00:00:00")])
    first.write.mode("append").parquet(src)
    shapes = plan_shapes(pipe, first) if declared else None
    run_available(spark, pipe, src, cp, shapes, audit="stream_audit")
    bronze([("teams", coach(2, "Bea"), None, "coaches_1_2024", "2024-01-02 00:00:00")]).write.mode("append").parquet(src)
    run_available(spark, pipe, src, cp, shapes, audit="stream_audit")
    run_available(spark, pipe, src, cp, shapes, audit="stream_audit")
    got = spark.table(f"{pipe.prefix}_coach")
    want = pipeline_tables(pipe, spark.read.parquet(src))["coach"]
    assert rows(got, *want.columns) == rows(want) and got.count() == 2
    assert [r[0].split("@")[1] for r in rows(got, "load_key")] == ["0", "1"] and spark.table("stream_audit").count() == 2
    drop_tables(spark, [f"{pipe.prefix}_coach", pipe.prefix, "stream_audit", "stream_errors"])


@pytest.mark.parametrize("first, second, kind, values", [
    ("1L", "1.75BD", "decimal(21,2)", ["1.00", "1.75"]), ("1.3BD", "1.26BD", "decimal(3,2)", ["1.26", "1.30"]), ("true", "7", "string", ["7", "true"]),
    ("7", "true", "string", ["7", "true"]), ("1L", "1.5D", "string", ["1", "1.5"]), ("1", "1.5D", "double", ["1.0", "1.5"]), ("1", "2L", "bigint", ["1", "2"]),
    ("110.5BD", "'a'", "string", ["110.5", "a"]), ("date'2024-01-01'", "timestamp'2024-01-01 05:00:00'", "timestamp", ["2024-01-01 00:00:00", "2024-01-01 05:00:00"]),
    ("named_struct('a', 1)", "'x'", "string", ["x", '{"a":1}']), ("null", "3", "string", ["3", None]), ("3", "null", "int", ["3", None]),
    # As text a decimal is what the payload said, like in one load of both: the column's trailing zeros go.
    ("123456789012345678901234567890BD", "0.1234567890BD", "string", ["0.123456789", "123456789012345678901234567890"]),
])
def test_append_never_narrows(spark, first, second, kind, values):
    drop_tables(spark, ["wide"])
    write_table(spark.sql(f"SELECT {first} AS v, 'a' AS part"), "wide", load="a")
    write_table(spark.sql(f"SELECT {second} AS v, 'b' AS part"), "wide", load="b")
    assert dict(spark.table("wide").dtypes)["v"] == kind
    assert sorted((r[0] for r in spark.sql("SELECT cast(v AS string) FROM wide").collect()), key=lambda x: (x is None, x)) == values
    assert rows(spark.table("wide"), "part") == [("a",), ("b",)]
    drop_tables(spark, ["wide"])


def files(spark, table):
    return {f for f in spark.table(table).inputFiles()}


def test_widening_writes_no_stored_row_again(spark):
    drop_tables(spark, ["torn"])
    write_table(spark.sql("SELECT 7L AS v"), "torn", load="k@1")
    first = files(spark, "torn")
    write_table(spark.sql("SELECT 1.25BD AS v"), "torn", load="k@2")
    second = files(spark, "torn")
    write_table(spark.sql("SELECT 'a' AS v"), "torn", load="k@3")
    assert first < second < files(spark, "torn")
    assert rows(spark.table("torn"), "v") == [("1.25",), ("7",), ("a",)] and spark.table("torn").columns == ["v", *LINEAGE, "load_key"]
    assert "PushedFilters: [IsNotNull(load_key)" not in spark.table("torn").filter("load_key = 'k@2'")._jdf.queryExecution().executedPlan().toString()
    assert len(spark.table("torn").filter("load_key = 'k@2'").inputFiles()) <= 3
    drop_tables(spark, ["torn"])


@pytest.mark.parametrize("step", ["_show", "_write_load", "_create", "_fit", "refresh"])
def test_a_writer_lost_at_any_step_is_repaired_by_the_next(spark, monkeypatch, step):
    from payloom.sinks import tables as sink

    drop_tables(spark, ["lost"])

    def attempt(value, load, broken):
        with monkeypatch.context() as m:
            if broken and step == "refresh":  # the rows are in place, the caller never hears of it
                write_table(spark.sql(f"SELECT {value} AS v, 9 AS stale"), "lost", load=load)
                return
            if broken:
                def fail(*args):
                    raise OSError("driver lost")
                m.setattr(sink, step, fail)
                with pytest.raises(OSError):
                    write_table(spark.sql(f"SELECT {value} AS v"), "lost", load=load)
                return
            write_table(spark.sql(f"SELECT {value} AS v"), "lost", load=load)

    for value, load in (("7L", "k@1"), ("1.25BD", "k@2"), ("'a'", "k@3")):
        attempt(value, load, step != "_create" or load == "k@1")
        attempt(value, load, False)
    assert rows(spark.table("lost"), "v", "load_key") == [("1.25", "k@2"), ("7", "k@1"), ("a", "k@3")]
    drop_tables(spark, ["lost"])


def test_files_of_a_lost_driver_are_not_rows(spark):
    drop_tables(spark, ["leftover"])
    folder = spark.catalog.getDatabase("default").locationUri
    junk = spark.sql("SELECT -1L AS v")
    for path in ("_temporary/0/task", ".spark-staging-1/load_key=k%401", "load_key=k%401", "load_key=gone"):
        junk.write.mode("overwrite").parquet(f"{folder}/leftover__a/{path}")
    assert write_table(spark.sql("SELECT 1L AS v"), "leftover", load="k@1") == 1
    assert rows(spark.table("leftover"), "v") == [(1,)]
    junk.write.mode("overwrite").parquet(f"{folder}/leftover__a/load_key=k%402")
    write_table(spark.sql("SELECT 2L AS v"), "leftover", load="k@2")
    assert write_table(spark.sql("SELECT 3L AS v WHERE false"), "leftover", load="k@1") == 0
    assert rows(spark.table("leftover"), "v") == [(2,)]
    drop_tables(spark, ["leftover"])


def test_a_full_load_supersedes_the_windows_of_its_key_alone(spark):
    drop_tables(spark, ["full"])
    for load, v in (("k@start", 1), ("k@2024-01-01T00:00:00", 2), ("kk@t", 3)):
        write_table(spark.sql(f"SELECT {v} AS v"), "full", load=load)
    write_table(spark.sql("SELECT explode(array(1, 2, 4)) AS v"), "full", load="k@start", supersedes="k@")
    assert rows(spark.table("full"), "v") == [(1,), (2,), (3,), (4,)]
    drop_tables(spark, ["full"])


def test_overwrite_replaces_columns_and_may_read_what_it_replaces(spark):
    drop_tables(spark, ["again"])
    write_table(spark.sql("SELECT 1 AS v, 'x' AS old"), "again", mode="overwrite")
    write_table(spark.table("again").selectExpr("v + 1 AS v", "'y' AS new"), "again", mode="overwrite", partition_by=["new"])
    assert rows(spark.table("again"), "v", "new") == [(2, "y")] and "old" not in spark.table("again").columns
    write_table(spark.sql("SELECT 1 AS v, 'z' AS new"), "again", mode="append", partition_by=["new"])
    assert rows(spark.table("again"), "v", "new") == [(1, "z"), (2, "y")]
    drop_tables(spark, ["again"])


def test_a_plain_table_becomes_a_store(spark):
    drop_tables(spark, ["plain_one"])
    spark.sql("SELECT 1 AS v").write.saveAsTable("plain_one")
    write_table(spark.sql("SELECT 2.5BD AS v"), "plain_one", load="k@1")
    assert rows(spark.table("plain_one"), "v") == [(Decimal("1.0"),), (Decimal("2.5"),)]
    drop_tables(spark, ["plain_one"])


def test_a_load_replaces_what_an_earlier_attempt_left(spark):
    drop_tables(spark, ["loads"])
    write_table(spark.sql("SELECT 1 AS v"), "loads")
    for load, v in (("k@'1'", 2), ("k@2", 3), ("k@'1'", 4)):
        write_table(spark.sql(f"SELECT {v} AS v"), "loads", load=load)
    assert rows(spark.table("loads"), "v") == [(1,), (3,), (4,)]
    drop_tables(spark, ["loads"])


def test_failed_run_leaves_no_repeats_when_run_again(spark, coaches, monkeypatch):
    from payloom.sinks import tables as sink

    coaches(("111", 1, "Ann", "2024-01-01 00:00:00"))
    pipe, write = pipeline("coaches"), sink.write_table

    def broken(df, target, *args):
        if target.endswith("_coach"):
            raise OSError("disk")
        return write(df, target, *args)

    for n in range(3):
        monkeypatch.setattr(sink, "write_table", broken if n < 2 else write)
        due = I.discover_runs(spark, [pipe], "run_audit", ["111"], ["2024"])
        if n < 2:
            with pytest.raises(RuntimeError):
                I.run_all(spark, due, "run_audit", "run_errors")
            # More arrives before the next attempt; the window grows, its start stays.
            coaches(("111", 2 + n, "Bea", f"2024-01-0{n + 2} 00:00:00"))
        else:
            I.run_all(spark, due, "run_audit", "run_errors")
    assert spark.table("bronze_stats_flatten.coaches").count() == 1
    assert rows(spark.table("bronze_stats_flatten.coaches_coach"), "coach_id") == [("c1",), ("c2",), ("c3",)]


def test_compaction_rewrites_touched_buckets_only(spark):
    from payloom.operators.keys import latest
    from payloom.sinks.compaction import compact, latest_rows, reopen

    names = ["kept", "kept__base", "kept__compacted"]
    drop_tables(spark, names)

    def load(name, low, high, at, v="id"):
        df = spark.range(low, high).selectExpr("id AS k", f"{v} AS v", f"timestamp'2024-01-0{at} 00:00:00' AS ingested_at", "'s' AS ingested_from")
        write_table(df, "kept", load=name)

    def same():
        want = latest(spark.table("kept").drop("load_key"), ("k",))
        assert rows(latest_rows(spark, "kept", ("k",)), "k", "v", "ingested_at") == rows(want, "k", "v", "ingested_at")

    load("l@1", 0, 200, 1)
    same()
    assert compact(spark, "kept", ("k",), buckets=16) == 16 and compact(spark, "kept", ("k",), buckets=16) == 0
    same()
    before = files(spark, "kept__base")
    load("l@2", 7, 8, 2, "id * 100")
    same()
    assert compact(spark, "kept", ("k",), buckets=16) == 1
    assert len(before - files(spark, "kept__base")) == 1
    same()
    # Older than what the base has, in a wider type, and a load that is loaded anew.
    load("l@3", 5, 9, 1, "concat('x', id)")
    same()
    compact(spark, "kept", ("k",), buckets=16)
    load("l@3", 300, 310, 3, "concat('y', id)")
    reopen(spark, "kept", "l@3")
    assert compact(spark, "kept", ("k",), buckets=16) > 1
    assert latest_rows(spark, "kept", ("k",)).count() == 210
    drop_tables(spark, names)


def test_late_loads_are_due_with_a_ledger_and_a_failed_run_leaves_no_repeats(spark, coaches, monkeypatch):
    from payloom.sinks import tables as sink

    drop_tables(spark, ["run_ledger"])
    pipe, write = pipeline("coaches"), sink.write_table

    def step(broken=False):
        def broken_write(df, target, *args):
            if target.endswith("_coach"):
                raise OSError("disk")
            return write(df, target, *args)

        due = I.discover_runs(spark, [pipe], "run_audit", ["111"], ["2024"], ledger="run_ledger")
        with monkeypatch.context() as m:
            if broken:
                m.setattr(sink, "write_table", broken_write)
                with pytest.raises(RuntimeError):
                    I.run_all(spark, due, "run_audit", "run_errors")
            else:
                I.run_all(spark, due, "run_audit", "run_errors")
        return len(due)

    coaches(("111", 1, "Ann", "2024-01-05 00:00:00"))
    assert step() == 1 and step() == 0
    coaches(("111", 2, "Bea", "2024-01-02 00:00:00"))
    assert step(broken=True) == 1
    coaches(("111", 3, "Cai", "2024-01-01 00:00:00"), ("222", 8, "Other", "2024-01-01 00:00:00"))
    assert step() == 1 and step() == 0
    assert rows(spark.table("bronze_stats_flatten.coaches_coach"), "coach_id", "full_name") == [("c1", "Ann"), ("c2", "Bea"), ("c3", "Cai")]
    assert spark.table("run_ledger").count() == 3 and spark.table("run_audit").count() == 2
    drop_tables(spark, ["run_ledger"])


def test_stream_drops_repeats(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01'), (1, timestamp'2024-01-01'), (2, timestamp'2024-01-01') AS t(k, ts)").write.parquet(src)
    stream = spark.readStream.schema("k int, ts timestamp").parquet(src)
    q = (drop_repeats(stream, ["k"], "ts", "1 hour").writeStream.format("memory").queryName("unique_rows")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("unique_rows"), "k") == [(1,), (2,)]


def test_dimension_tables_have_the_declared_columns(spark):
    create_dimension_tables(spark, "silver")
    for dim in DIMENSIONS.values():
        assert spark.table(f"silver.{dim.name}").columns == dim.schema.names
    spark.sql("DROP DATABASE silver CASCADE")


# One hand-written payload per quirk that the generated feeds do not have.

def test_player_season_falls_back_to_the_source_id(bronze):
    player = {"playerId": "1", "season": [{"seasonId": "1999", "seasonStatsTotal": {"tries": "2"}},
                                          {"seasonStatsTotal": {"tries": "3"}}, {"seasonStatsTotal": {}}]}
    df = bronze([("players", json.dumps({"player": player}), None, "historical_stats_by_round_111_2024")])
    out = pipeline_tables(pipeline("playerstatsmaster"), df)
    assert rows(out["season_total"], "player_id", "season_id", "tries") == [("1", "1999", "2"), ("1", "2024", "3")]
    assert rows(out[""], "competition_id", "season_id") == [("111", "2024")]


def test_null_wrapper_means_self_and_empty_list_means_no_rows(bronze):
    df = bronze([("commentaryFlow", p, None, "match_events_flow_1_2024_9") for p in (
        '{"event": [], "statId": "no"}', '{"event": null, "statId": "self"}', '{"statId": "plain"}', '[{"statId": "list"}]')])
    out = pipeline_tables(pipeline("eventflow"), df, only=("commentary",))["commentary"]
    assert rows(out, "stat_id", "game_id") == [("list", "9"), ("plain", "9"), ("self", "9")]


def test_bad_l0_payload_is_null_not_an_error(bronze):
    df = bronze([("teams", coach(1, "Ann"), "{bad", "coaches_1_2024"), ("teams", coach(2, "Bea"), "[1]", "coaches_2_2024")])
    out = pipeline_tables(pipeline("coaches"), df)[""]
    assert rows(out, "competition_id", "competition_name") == [("1", None), ("2", None)]


def test_empty_source_gives_empty_tables(bronze):
    df = bronze([("teams", "[]", None, "coaches_1_2024")]).filter("false")
    out = pipeline_tables(pipeline("coaches"), df)
    assert {k: v.count() for k, v in out.items()} == {"": 0, "coach": 0}


def test_registry_and_output_names():
    assert len(PIPELINES) == 32
    with pytest.raises(KeyError, match="no pipeline"):
        pipeline("matchstats")
    assert len({p.prefix for p in PIPELINES.values()}) == 32


def test_plan_of_a_deep_table_has_no_shuffle(bronze):
    df = bronze([("players", '[{"playerId":"1","season":{"seasonStatsTotal":{"roundStats":{"round":{"roundNumber":"1"}}}}}]',
                  None, "player_stats_v2_1_2024")])
    plan = pipeline_tables(pipeline("playerstatsv2"), df, only=("round",))["round"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and plan.count("Generate ") == 4


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark, sf):
    from payloom.operators.keys import latest

    df = latest(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"], ["l_shipdate"], ["l_partkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_xy_events_are_made_distinct_without_a_shuffle_of_events(bronze):
    event = '{"SI":"1","T":"0"}'
    df = bronze([("teams", f'{{"team":[{{"teamId":"1","xandYFeed1stHalf":{{"stat":[{event},{event}]}}}}]}}', '{"gameId":"9"}', "live_xy_1_2024_9")] * 2)
    out = pipeline_tables(pipeline("livexy"), df, only=("teams_stat",))["teams_stat"]
    assert out.count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")


def test_shapes_of_all_trees_take_two_queries(spark, bronze):
    df = bronze([("teams", '{"teamsMatch":[{"teamId":"1","teamCoach":{"coachId":"2"}}]}', '{"gameId":"9"}', "match_stats_1_2024"),
                 ("gameInfo", '{"city":"x"}', '{"gameId":"9"}', "match_stats_1_2024")])
    spark.sparkContext.setJobGroup("shapes", "shapes")
    plan_shapes(pipeline("matchdata"), df)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One sizes the schemas of all nodes, so that objects keyed by data are never merged, one merges them; adaptive
    # execution runs the map side of each aggregate as a job of its own. More trees take no more.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("shapes")) <= 4


def test_scd2_shuffles_rows_once(spark, sf):
    from payloom.operators.scd import scd2

    df = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_custkey", "o_orderstatus", "o_totalprice AS price", "o_orderdate")
    plan = scd2(df, ["o_custkey"], ["o_orderstatus"], "o_orderdate", carry=("price",))._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning(__k" in x and "__chunk" in x]
    assert len(wide) <= 3


@pytest.mark.parametrize("name, feed", [("playerstatsv2", "player_stats_v2"), ("playerstatsmaster", "historical_stats_by_round")])
def test_shared_hops_give_the_same_tables_from_three_reads_of_the_element(spark, sf, tmp_path, name, feed):
    from payloom.suite.domain_players import players_bronze

    players_bronze(feed)(spark, sf).limit(400).write.parquet(f"{tmp_path}/bronze")
    df = spark.read.parquet(f"{tmp_path}/bronze")
    pipe = pipeline(name)
    shapes = plan_shapes(pipe, df)
    plain, shared = pipeline_tables(pipe, df, shapes), pipeline_tables(pipe, df, shapes, shared=f"test/{name}")
    assert list(plain) == list(shared)
    for suffix in plain:
        assert plain[suffix].columns == shared[suffix].columns, suffix
        # Each table once, in one column of text, so that rows of all types can be compared.
        left, right = ([r[0] for r in t.selectExpr("to_json(struct(*)) AS j").orderBy("j").collect()] for t in (plain[suffix], shared[suffix]))
        assert left == right and (left or suffix == "competition_average"), suffix
    direct = [t for t, out in shared.items() if any("/bronze/" in f for f in out.inputFiles())]
    # These, and the one read that wrote the shared hop.
    assert {"", "player"} <= set(direct) <= {"", "player", "competition_average"}


def test_shared_hop_with_spellings_of_a_key_and_an_empty_source(spark, bronze, monkeypatch):
    from payloom.operators import entities as E
    from payloom.plans.spec import Node
    from payloom.sources.bronze import stage

    monkeypatch.setattr(E, "SHARED_FROM", 2)
    value = (Field("v", "v"),)
    root = Root(table="r", element="e", fields=(Field("id", "id"),), hand_down=(Field("id", "r_id"),), children=(
        Node(table="a", path=("part",), fields=value), Node(table="b", path=("Part",), list_key="x", fields=value)))
    df = bronze([("e", '{"id":"1","part":{"v":"p"},"Part":{"x":[{"v":"q"},{"v":null}]}}'), ("e", '{"id":"2"}'), ("e", None)])
    for source in (df, df.filter("false")):
        plain = E.build_tables(source, (root,), {})
        shared = E.build_tables(source, (root,), {}, store=lambda f: stage(f, f"spellings/{source is df}", by=()))
        for t in "rab":
            assert sorted(map(tuple, plain[t].collect()), key=repr) == sorted(map(tuple, shared[t].collect()), key=repr)
    assert plain["b"].columns == ["v", "r_id"]
