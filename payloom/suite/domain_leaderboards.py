"""Leaderboard and milestone feeds, with payloads made from line items."""

from __future__ import annotations

from payloom.plans.catalog import pipeline
from payloom.plans.catalog import leaderboards as L
from payloom.suite.base import Either, bronze_rows, domain_query, table, text

# Value of each entry field, as SQL that Spark and DuckDB both read.
ENTRY = {
    "TeamID": "l_suppkey", "TeamName": "l_returnflag", "TeamAbbrev": "l_linestatus", "PlayerID": "l_partkey",
    "PlayerName": "l_returnflag", "PositionID": "l_linenumber", "PositionName": "l_linestatus", "Rank": "l_linenumber",
    "Value": "l_partkey % 100", "Appearances": "l_suppkey % 10", "OpponentId": "l_suppkey + 1",
    "OpponentName": "l_linestatus", "SeasonId": "year(l_shipdate)", "RoundId": "l_linenumber % 3",
    "RequiredAmount": "l_partkey % 7", "Achieved": "l_suppkey % 2", "GameID": "l_orderkey",
}


def entry(second: bool, fields) -> dict[str, str]:
    """The first or second entry of a statistic; the second is one rank lower."""
    return {k: text(v if not (second and k == "Rank") else f"({v}) + 1") for k, v in ENTRY.items() if k in fields}


def stat(number: int, key: str, fields) -> dict:
    one, two = entry(False, fields), entry(True, fields)
    return {"ID": text(f"l_partkey + {number}"), "statName": "concat('s', l_suppkey)", key: Either(
        "l_orderkey % 3 = 0", one, Either("l_orderkey % 3 = 1", [one, two], []))}


def source_id(prefix: str, parts: int) -> str:
    values = ["l_returnflag", "year(l_shipdate)", "l_linenumber"][:parts]
    return "concat(" + ", ".join([f"'{prefix}'", *[f"'_', {v}" for v in values]]) + ")"


def leaderboard_bronze(pipe_name: str, key: str, fields):
    pipe = pipeline(pipe_name)
    prefix = pipe.source.split(".")[1]

    def make(spark, sf):
        one, two = stat(0, key, fields), stat(1, key, fields)
        payload = Either("l_linenumber % 3 = 0", {"leaderboardStat": one}, Either(
            "l_linenumber % 3 = 1", {"leaderboardStat": [one, two]}, [one, two]))
        return bronze_rows(table(spark, sf, "lineitem"), source_id(prefix, len(pipe.id_parts)), "l_shipdate",
                           {"stats": ("true", payload)},
                           l0={"competitionName": "concat('c', l_returnflag)"})

    return make


def _sql_id(pipe) -> str:
    values = ["l_returnflag", "year(l_shipdate)", "l_linenumber"][:len(pipe.id_parts)]
    return " || ".join([f"'{pipe.source.split('.')[1]}'", *[f"'_' || {v}" for v in values]])


def _context_sql(pipe) -> str:
    ids = dict(zip(pipe.id_parts, ["l_returnflag", "year(l_shipdate)", "l_linenumber"]))
    cols = [f"CAST({v} AS varchar) AS {k}" for k, v in ids.items()]
    cols += [f"'{v}' AS {k}" for k, v in pipe.constants.items()]
    return ", ".join([f"{_sql_id(pipe)} AS ingested_from", "CAST(l_shipdate AS varchar) AS ingested_at", *cols])


STATS_SQL = "lineitem, (SELECT unnest([0, 1]) AS s) WHERE (s = 0 OR l_linenumber % 3 <> 0)"


def register(pipe_name: str, columns, suffixes, key: str = "leaderboardEntry", named: bool = True,
             root_name: bool = True) -> None:
    pipe = pipeline(pipe_name)
    make = leaderboard_bronze(pipe_name, key, set(columns.values()))
    root, stat_table, entry_table = suffixes
    context = _context_sql(pipe)
    ids = ", ".join([*pipe.id_parts, *pipe.constants])
    name_sql = ", 'c' || l_returnflag AS competition_name" if root_name else ""
    domain_query(f"{pipe_name}_root", make, pipe_name, root, f"""
        SELECT * FROM (SELECT {context}{name_sql} FROM lineitem) QUALIFY row_number() OVER (
          PARTITION BY {ids} ORDER BY ingested_at, ingested_from) = 1""")
    domain_query(f"{pipe_name}_stat", make, pipe_name, stat_table, f"""
        SELECT CAST(l_partkey + s AS varchar) AS stat_id, 's' || l_suppkey AS stat_name, {context} FROM {STATS_SQL}""")
    fields = ", ".join(
        f"CAST({ENTRY[j]}{' + e' if j == 'Rank' else ''} AS varchar) AS {c}" for c, j in columns.items()
        if c not in pipe.constants and c not in pipe.id_parts)
    stat_name = ", 's' || l_suppkey AS stat_name" if named else ""
    domain_query(f"{pipe_name}_entry", make, pipe_name, entry_table, f"""
        SELECT CAST(l_partkey + s AS varchar) AS stat_id{stat_name}, {fields}, {context}
        FROM (SELECT * FROM {STATS_SQL}), (SELECT unnest([0, 1]) AS e)
        WHERE (l_orderkey % 3 = 0 AND e = 0) OR l_orderkey % 3 = 1""")


PLAYER_ENTRY = {**L.TEAM, **L.PLAYER, **L.POSITION, **L.RANKED}
register("playerleaderboard", PLAYER_ENTRY, L.SHORT, named=False)
register("playerleaderboardsaverage", PLAYER_ENTRY, L.SHORT, named=False)
register("teamleaderboards", {**L.TEAM, **L.RANKED}, L.LONG)
register("teamleaderboardsaverage", {**L.TEAM, **L.RANKED}, L.LONG)
register("teamleaderboardsperformance", {**L.TEAM, **L.OPPONENT, **L.RANKED}, L.LONG)
register("teamleaderboard", {**L.TEAM, **L.RANKED}, ("", "stat", "entry"))
register("competitionteamcareerbestleaderboardreport", {**L.TEAM, **L.RANKED, **L.CAREER_BEST, **L.OPPONENT}, L.SHORT)
register("playermilestones", {**L.PLAYER, "team_id": "TeamID", "team_name": "TeamName", **L.MILESTONE},
         ("", "leaderboard_stat", "milestone_entry"), key="milestoneEntry", root_name=False)


# Top three: team, statistic, entry ---------------------------------------------

TOP_FIELDS = set(L.TOP_THREE.values())


def top_three_bronze(spark, sf):
    one = {"ID": text("l_partkey"), "statName": "l_linestatus", "statEntry": Either(
        "l_orderkey % 2 = 0", entry(False, TOP_FIELDS), [entry(False, TOP_FIELDS), entry(True, TOP_FIELDS)])}
    team = {"TeamID": text("l_suppkey"), "TeamName": "l_returnflag", "TeamAbbreviation": "l_linestatus",
            "stats": {"stat": Either("l_linenumber % 2 = 0", one, [one, one])}}
    return bronze_rows(table(spark, sf, "lineitem"), "concat('top_three_leaderboard_', l_returnflag)", "l_shipdate",
                       {"teams": ("true", Either("l_linenumber % 3 = 0", {"team": team}, Either(
                           "l_linenumber % 3 = 1", {"team": [team]}, [team])))},
                       l0={"competitionName": "concat('c', l_returnflag)"})


TOP = ("'top_three_leaderboard_' || l_returnflag AS ingested_from, CAST(l_shipdate AS varchar) AS ingested_at, "
       "l_returnflag AS competition_id")
TOP_TEAM = f"CAST(l_suppkey AS varchar) AS team_id, l_returnflag AS team_name, {TOP}"
TOP_STAT = f"CAST(l_partkey AS varchar) AS stat_id, l_linestatus AS stat_name, {TOP_TEAM}"
REPORT = "competitionteamtopthreeleaderboardreport"
TWO = "(SELECT unnest([0, 1]) AS {0})"
domain_query("top_three_root", top_three_bronze, REPORT, "leaderboard", f"""
    SELECT {TOP}, 'c' || l_returnflag AS competition_name FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) = 1""")
domain_query("top_three_team", top_three_bronze, REPORT, "team",
             f"SELECT {TOP_TEAM}, l_linestatus AS team_abbrev FROM lineitem")
domain_query("top_three_stat", top_three_bronze, REPORT, "stat",
             f"SELECT {TOP_STAT} FROM lineitem, {TWO.format('s')} WHERE s = 0 OR l_linenumber % 2 = 1")
domain_query("top_three_entry", top_three_bronze, REPORT, "entry", f"""
    SELECT {TOP_STAT}, CAST(l_orderkey AS varchar) AS game_id, CAST(l_linenumber + e AS varchar) AS rank,
           CAST(year(l_shipdate) AS varchar) AS season_id, CAST(l_partkey % 100 AS varchar) AS value
    FROM lineitem, {TWO.format('s')}, {TWO.format('e')}
    WHERE (s = 0 OR l_linenumber % 2 = 1) AND (e = 0 OR l_orderkey % 2 = 1)""")


# Match milestones ----------------------------------------------------------------

def milestones_bronze(spark, sf):
    def goal(number: int, player: bool) -> dict:
        base = {"Value": text(f"o_orderkey % 50 + {number}"), "RequiredAmount": text("o_custkey"), "Achieved": "'1'"}
        return {**base, "PlayerID": text(f"o_custkey + {number}"), "PlayerName": "o_orderpriority"} if player else base

    team = {"TeamID": text("o_custkey"), "TeamName": "o_orderstatus",
            "teamStats": {"stats": {"leaderboardStat": {"ID": "'7'", "statName": "'Points'",
                                                        "milestoneEntry": goal(0, False)}}},
            "playerStats": {"stats": {"leaderboardStat": [{"ID": "'8'", "statName": "'Tries'", "milestoneEntry": Either(
                "o_orderkey % 2 = 0", goal(0, True), [goal(0, True), goal(1, True)])}]}}}
    return bronze_rows(
        table(spark, sf, "orders"),
        "concat('upcoming_match_milestones_', o_orderstatus, '_', year(o_orderdate), '_x_', o_orderkey)", "o_orderdate",
        {"teams": ("true", Either("o_orderkey % 3 = 0", {"team": [team]}, Either("o_orderkey % 3 = 1", [team], team)))},
        l0=Either("o_orderkey % 4 = 0", {}, {"gameId": text("o_orderkey"), "Team1Name": "o_orderpriority"}))


MILE = ("'upcoming_match_milestones_' || o_orderstatus || '_' || year(o_orderdate) || '_x_' || o_orderkey AS ingested_from, "
        "CAST(o_orderdate AS varchar) AS ingested_at, o_orderstatus AS competition_id, "
        "CAST(year(o_orderdate) AS varchar) AS season_id, CAST(o_orderkey AS varchar) AS game_id")
MILE_TEAM = f"CAST(o_custkey AS varchar) AS team_id, o_orderstatus AS team_name, {MILE}"
domain_query("matchmilestones_root", milestones_bronze, "matchmilestones", "",
             f"SELECT {MILE}, o_orderpriority AS team1_name FROM orders WHERE o_orderkey % 4 <> 0")
domain_query("matchmilestones_team", milestones_bronze, "matchmilestones", "team", f"""
    SELECT '7' AS stat_id, 'Points' AS stat_name, CAST(o_orderkey % 50 AS varchar) AS value,
           CAST(o_custkey AS varchar) AS required_amount, '1' AS achieved, {MILE_TEAM} FROM orders""")
domain_query("matchmilestones_player_stat", milestones_bronze, "matchmilestones", "player_stat",
             f"SELECT '8' AS stat_id, 'Tries' AS stat_name, {MILE_TEAM} FROM orders")
domain_query("matchmilestones_player_stat_entry", milestones_bronze, "matchmilestones", "player_stat_entry", f"""
    SELECT '8' AS stat_id, 'Tries' AS stat_name, CAST(o_custkey + e AS varchar) AS player_id,
           o_orderpriority AS player_name, CAST(o_orderkey % 50 + e AS varchar) AS value,
           CAST(o_custkey AS varchar) AS required_amount, '1' AS achieved, {MILE_TEAM}
    FROM orders, {TWO.format('e')} WHERE e = 0 OR o_orderkey % 2 = 1""")
