"""Quality plans of whole pipelines, with checks that pass, fail and break."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.plans.catalog import pipeline
from payloom.plans.checks import check_pipelines
from payloom.plans.tables import pipeline_tables
from payloom.suite.base import query
from payloom.suite.domain_matches import MD, match_data_bronze
from payloom.suite.domain_reference import entities_bronze, fixtures_bronze, ladder_bronze


def result_sql(check_id: str, count: str) -> str:
    return f"SELECT '{check_id}' AS check_id, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS bad_rows FROM (SELECT ({count})::bigint AS n)"


def error_sql(check_id: str) -> str:
    return f"SELECT '{check_id}', 'ERROR', NULL::bigint"


def empty_sql(rows: str) -> str:
    return f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ({rows})"


INFO = f"SELECT DISTINCT game_id FROM (SELECT {MD} FROM lineitem WHERE l_linenumber <= 3)"
TEAM = f"SELECT DISTINCT game_id, ingested_from, team_id FROM (SELECT {MD}, CAST(l_suppkey AS varchar) AS team_id FROM lineitem WHERE l_linenumber > 3)"
PASSING = [
    *(("matchdata.gameinfo", INFO, ("game_id",)), ("matchdata.teams", TEAM, ("game_id", "ingested_from")), ("matchdata.teams_match", TEAM, ("game_id", "team_id")),
      ("matchdata.team_coach", TEAM, ("game_id", "team_id", "coach_id")), ("matchdata.ins_outs", TEAM, ("game_id", "team_id", "player_id")),
      ("entities.competition", "FROM region", ("id",)), ("entities.venue", "FROM nation", ("id",)), ("entities.player", "FROM customer", ("id",))),
]
RESULTS = [
    *[result_sql(f"{t}:rows", empty_sql(rows)) for t, rows, _ in PASSING],
    *[result_sql(f"{t}:{c}", f"SELECT count(*) FROM ({rows}) WHERE NULL") for t, rows, keys in PASSING for c in ("unique", *keys)],
    result_sql("matchdata.teams_match:2 rows", f"SELECT count(*) FROM (SELECT game_id FROM ({TEAM}) GROUP BY 1 HAVING count(*) <> 2)"),
    result_sql("matchdata.teams_match:in gameinfo", f"SELECT count(*) FROM ({TEAM}) WHERE game_id NOT IN ({INFO})"),
    # The ladder of this feed has neither competition nor season; three kinds of entities aren't in it.
    result_sql("ladder.ladderposition:rows", empty_sql("FROM orders")), result_sql("ladder.ladderposition:team_id", "SELECT count(*) FROM orders WHERE o_custkey IS NULL"),
    *[error_sql(f"ladder.ladderposition:{c}") for c in ("unique", "competition_id", "season_id")],
    *[error_sql(f"entities.{t}:{c}") for t in ("team", "position", "statistic") for c in ("rows", "unique", "id")],
    result_sql("fixtures.source:rows", empty_sql("FROM orders")), result_sql("fixtures.source:ingested_at", "SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0"),
    *[error_sql(f"coaches.source:{c}") for c in ("rows", "ingested_at")],
]


@query("pipeline_checks", " UNION ALL ".join(RESULTS))
def pipeline_checks(spark, sf):
    feeds = {"matchdata": match_data_bronze, "ladder": ladder_bronze("ladder"), "entities": entities_bronze("players")}
    outputs = {name: pipeline_tables(pipeline(name), make(spark, sf)) for name, make in feeds.items()}

    def fixtures():
        timeless = F.expr("CAST(substring_index(ingested_from, '_', -1) AS bigint) % 10 = 0")
        return fixtures_bronze("fixtures")(spark, sf).withColumn("ingested_at", F.when(~timeless, F.col("ingested_at")))

    return check_pipelines(spark, outputs, {"fixtures": fixtures, "coaches": lambda: spark.table("no_such_source")})
