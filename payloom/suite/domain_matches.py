"""Match feeds, with payloads made from line items and orders."""

from __future__ import annotations

from payloom.plans.catalog.matches import XY_FIELDS
from payloom.suite.base import Either, bronze_rows, domain_query, reloaded, table, text

AT = "CAST(l_shipdate AS varchar) AS ingested_at"
TWO = "(SELECT unnest([0, 1]) AS {0}) {0}"
TEAM = {"teamId": text("l_suppkey"), "teamName": "l_returnflag", "isHomeTeam": text("l_linenumber % 2")}
TEAM_SQL = ("CAST(l_suppkey AS varchar) AS team_id, l_returnflag AS team_name, "
            "CAST(l_linenumber % 2 AS varchar) AS is_home_team")


def item_context(prefix: str) -> str:
    return (f"'{prefix}_' || l_returnflag || '_' || year(l_shipdate) || '_x_' || l_orderkey AS ingested_from, {AT}, "
            "l_returnflag AS competition_id, CAST(year(l_shipdate) AS varchar) AS season_id, "
            "CAST(l_orderkey AS varchar) AS game_id")


def item_id(prefix: str) -> str:
    return f"concat_ws('_', '{prefix}', l_returnflag, year(l_shipdate), 'x', l_orderkey)"


def event(i: int) -> dict:
    return {"statId": text(f"l_partkey + {i}"), "gameTime": text("l_linenumber"), "utcTime": "cast(null as string)"}


def event_sql(n: str) -> str:
    return (f"CAST(l_partkey + {n} AS varchar) AS stat_id, CAST(l_linenumber AS varchar) AS game_time, "
            "CAST(NULL AS varchar) AS utc_time")


def swap(i: int) -> dict:
    off = {"off": {"playerId": text("l_orderkey"), "shirtNum": "'9'"}, "number": f"'{i}'"}
    return off if i else {**off, "on": {"playerId": text("l_partkey")}}


ONE_OR_TWO = "l_orderkey % 2 = 0"


def one_or_two(make, empty: str = "false"):
    return Either(empty, [], Either(ONE_OR_TWO, make(0), [make(0), make(1)]))


SWAPS = {**TEAM, "interchanges": one_or_two(swap)}
CARDS = Either("l_orderkey % 5 = 0", TEAM, {**TEAM, "events": one_or_two(lambda i: {
    "yellow": f"'{i}'", "playerId": text("l_partkey")})})
SWAP_SQL = f"""
    SELECT CAST(e AS varchar) AS number, CASE WHEN e = 0 THEN CAST(l_partkey AS varchar) END AS on_player_id,
           CAST(l_orderkey AS varchar) AS off_player_id, '9' AS off_shirt_num, {{0}}
    FROM lineitem, {TWO.format('e')} WHERE {{1}} AND (e = 0 OR l_orderkey % 2 = 1)"""
CARD_SQL = f"""
    SELECT CAST(e AS varchar) AS yellow, CAST(l_partkey AS varchar) AS player_id, {{0}}
    FROM lineitem, {TWO.format('e')} WHERE {{1}} AND l_orderkey % 5 <> 0 AND (e = 0 OR l_orderkey % 2 = 1)"""


# Event flow -----------------------------------------------------------------------------

def event_flow_bronze(spark, sf):
    def point(kind: str):
        return {f"{kind}Event": {f"stat{kind.capitalize()}Event": one_or_two(event, "l_orderkey % 7 = 0")}}

    scorer = {**TEAM, "points": text("l_orderkey % 50"), "statScoringEvent": one_or_two(event)}
    return bronze_rows(
        table(spark, sf, "lineitem"), item_id("match_events_flow"), "l_shipdate",
        {"scoreFlow": ("l_linenumber = 1", {"scoreEvent": {"teams": {"team": Either(
            ONE_OR_TWO, scorer, [scorer])}}}),
         "possessionFlow": ("l_linenumber = 2", point("possession")),
         "penaltyFlow": ("l_linenumber = 3", point("penalty")),
         "errorFlow": ("l_linenumber = 4", point("error")),
         "scrumFlow": ("l_linenumber = 5", point("scrum")),
         "interchangeFlow": ("l_linenumber = 6", Either(ONE_OR_TWO, {"team": [SWAPS]}, SWAPS)),
         "commentaryFlow": ("l_linenumber = 7", {"event": one_or_two(event)}),
         "colourEventsFlow": ("l_linenumber = 1", one_or_two(event)),
         "disciplineFlow": ("l_linenumber = 2", {"team": CARDS})},
        l0={"competitionId": "concat('l0', l_returnflag)", "competitionName": "l_linestatus",
            "gameId": text("l_orderkey"), "roundId": text("l_partkey")})


EF = item_context("match_events_flow")
domain_query("eventflow_root", event_flow_bronze, "eventflow", "", f"""
    WITH r AS (SELECT * REPLACE ('l0' || competition_id AS competition_id), l_linestatus AS competition_name,
                      CAST(l_partkey AS varchar) AS round_id
               FROM (SELECT {EF}, l_linestatus, l_partkey, l_linenumber FROM lineitem))
    SELECT game_id, max(ingested_from) AS ingested_from, max(ingested_at) AS ingested_at, max(competition_id) AS competition_id,
           max(season_id) AS season_id, arg_max(competition_name, (ingested_at, ingested_from, competition_name)) AS competition_name,
           arg_max(round_id, (ingested_at, ingested_from, round_id)) AS round_id
    FROM r GROUP BY game_id, ingested_from""")
for _suffix, _n in {"possession": 2, "penalty": 3, "error": 4, "scrum": 5}.items():
    domain_query(f"eventflow_{_suffix}", event_flow_bronze, "eventflow", _suffix, f"""
        SELECT {event_sql('e')}, {EF} FROM lineitem, {TWO.format('e')}
        WHERE l_linenumber = {_n} AND l_orderkey % 7 <> 0 AND (e = 0 OR l_orderkey % 2 = 1)""")
for _suffix, _n in {"commentary": 7, "colour": 1}.items():
    domain_query(f"eventflow_{_suffix}", event_flow_bronze, "eventflow", _suffix, f"""
        SELECT {event_sql('e')}, {EF} FROM lineitem, {TWO.format('e')}
        WHERE l_linenumber = {_n} AND (e = 0 OR l_orderkey % 2 = 1)""")
domain_query("eventflow_score_team", event_flow_bronze, "eventflow", "score_team", f"""
    SELECT CAST(l_orderkey % 50 AS varchar) AS points, {TEAM_SQL}, {EF} FROM lineitem WHERE l_linenumber = 1""")
domain_query("eventflow_score_event", event_flow_bronze, "eventflow", "score_event", f"""
    SELECT {event_sql('e')}, {TEAM_SQL}, {EF} FROM lineitem, {TWO.format('e')}
    WHERE l_linenumber = 1 AND (e = 0 OR l_orderkey % 2 = 1)""")
domain_query("eventflow_interchange", event_flow_bronze, "eventflow", "interchange",
             SWAP_SQL.format(f"{TEAM_SQL}, {EF}", "l_linenumber = 6"))
domain_query("eventflow_discipline", event_flow_bronze, "eventflow", "discipline",
             CARD_SQL.format(f"{TEAM_SQL}, {EF}", "l_linenumber = 2"))


# Match snapshot ---------------------------------------------------------------------------

def snapshot_bronze(spark, sf):
    def player(i: int) -> dict:
        return {"playerId": text(f"l_partkey + {i}"), "positionAbbrev": Either(
            "l_linenumber % 3 = 0", {"#text": "l_linestatus"}, "l_linestatus"), "playerStats": {"tackles": text("l_orderkey % 30")}}

    lineup = {"teamLineUpStatus": "'final'", "teamPlayer": one_or_two(player)}
    one = {**TEAM, "status": "l_linestatus", "score": {"points": text("l_orderkey % 40")},
           "teamLineup": Either("l_orderkey % 3 = 0", {**lineup, "status": "'lineup'"}, lineup),
           "teamStats": {"allGoals": text("l_orderkey % 11")}}
    return bronze_rows(
        table(spark, sf, "lineitem"), item_id("match_snapshot"), "l_shipdate",
        {"gameInfo": ("l_linenumber = 1", Either(ONE_OR_TWO, {"crowd": text("l_partkey")}, [{"crowd": text("l_partkey")}])),
         "teams": ("l_linenumber <= 3", Either(ONE_OR_TWO, {"teamsMatch": [one]}, [one])),
         "interchangeFlow": ("l_linenumber = 4", Either(ONE_OR_TWO, {"team": SWAPS}, [SWAPS])),
         "injuriesAndSuspensions": ("l_linenumber = 5", one_or_two(lambda i: {"playerId": text(f"l_partkey + {i}")},
                                                                   "l_orderkey % 3 = 0")),
         "disciplineFlow": ("l_linenumber >= 6", Either(ONE_OR_TWO, {"team": CARDS}, [CARDS]))},
        l0={"gameState": "l_linestatus", "gameId": text("l_orderkey")})


MS = item_context("match_snapshot")
domain_query("matchsnapshot_root", snapshot_bronze, "matchsnapshotdata", "", f"""
    WITH r AS (SELECT {MS}, l_linestatus AS game_state, CAST(l_partkey AS varchar) AS crowd, 0 AS part, l_linenumber
               FROM lineitem),
    u AS (SELECT * REPLACE (NULL AS crowd) FROM r UNION ALL SELECT * REPLACE (1 AS part, NULL AS game_state) FROM r WHERE l_linenumber = 1)
    SELECT game_id, competition_id, season_id, ingested_from,
           arg_max(ingested_at, (part, ingested_at)) AS ingested_at,
           arg_max(game_state, (part, ingested_at, ingested_from, game_state)) FILTER (WHERE game_state IS NOT NULL) AS game_state,
           arg_max(crowd, (part, ingested_at, ingested_from, crowd)) FILTER (WHERE crowd IS NOT NULL) AS crowd
    FROM u GROUP BY ALL""")
domain_query("matchsnapshot_team", snapshot_bronze, "matchsnapshotdata", "team", f"""
    SELECT CAST(l_orderkey % 40 AS varchar) AS score_points, 'final' AS team_line_up_status,
           CASE WHEN l_orderkey % 3 = 0 THEN 'lineup' ELSE l_linestatus END AS status,
           CAST(l_orderkey % 11 AS varchar) AS team_stats_all_goals, {TEAM_SQL}, {MS} FROM lineitem WHERE l_linenumber <= 3""")
domain_query("matchsnapshot_team_player", snapshot_bronze, "matchsnapshotdata", "team_player", f"""
    SELECT CAST(l_partkey + p AS varchar) AS player_id, l_linestatus AS position_abbrev,
           CAST(l_orderkey % 30 AS varchar) AS player_stats_tackles, {TEAM_SQL}, {MS}
    FROM lineitem, {TWO.format('p')} WHERE l_linenumber <= 3 AND (p = 0 OR l_orderkey % 2 = 1)""")
domain_query("matchsnapshot_interchange", snapshot_bronze, "matchsnapshotdata", "interchange",
             SWAP_SQL.format(f"{TEAM_SQL}, {MS}", "l_linenumber = 4"))
domain_query("matchsnapshot_injuries", snapshot_bronze, "matchsnapshotdata", "injuries_suspensions", f"""
    SELECT CAST(l_partkey + p AS varchar) AS player_id, {MS} FROM lineitem, {TWO.format('p')}
    WHERE l_linenumber = 5 AND l_orderkey % 3 <> 0 AND (p = 0 OR l_orderkey % 2 = 1)""")
domain_query("matchsnapshot_discipline", snapshot_bronze, "matchsnapshotdata", "discipline",
             CARD_SQL.format(f"{TEAM_SQL}, {MS}", "l_linenumber >= 6"))


# Match statistics and events: field names are kept as they are ------------------------------

def match_events_bronze(spark, sf):
    def player(i: int) -> dict:
        return {"playerId": text(f"l_partkey + {i}"), "playerStats": {"tackles": text("l_orderkey % 30")}}

    one = {"teamId": text("l_suppkey"), "score": {"points": "'4'"}, "teamStats": {"tries": "'1'"},
           "teamLineup": {"teamPlayer": one_or_two(player)}}
    stats = {"gameId": text("l_orderkey"), "gameState": "l_linestatus", "teams": {"teamsMatch": Either(ONE_OR_TWO, one, [one])}}

    def point(kind: str):
        return {f"{kind}Event": {f"stat{kind.capitalize()}Event": one_or_two(event)}}

    scorer = {**TEAM, "points": text("l_orderkey % 50"), "statScoringEvent": one_or_two(event)}
    flow = {"gameId": text("l_orderkey"), "competitionId": "l_returnflag", "roundId": text("l_linenumber"), "seasonId": "'s'",
            "scoreFlow": {"scoreEvent": {"teams": {"team": [scorer]}}},
            **{f"{k}Flow": point(k) for k in ("possession", "penalty", "error", "scrum")},
            "interchangeFlow": {"team": SWAPS}, "disciplineFlow": {"team": [CARDS]},
            "commentaryFlow": {"event": [event(0), {"nested": {"x": "1"}}]}, "colourEventsFlow": {"event": event(0)}}
    return bronze_rows(
        table(spark, sf, "lineitem"), "concat('match_stats_and_events_', l_orderkey)", "l_shipdate",
        {"gameStats": ("l_linenumber <= 3", Either("l_linenumber = 1", [stats], stats)),
         "eventFlow": ("l_linenumber > 3", Either("l_linenumber = 4", [flow], flow))})


ME_GAME = f"'match_stats_and_events_' || l_orderkey AS ingested_from, {AT}, CAST(l_orderkey AS varchar) AS game_id"
ME_FLOW = f"{ME_GAME}, l_returnflag AS competition_id, CAST(l_linenumber AS varchar) AS round_id, 's' AS season_id"
RAW_TEAM = 'CAST(l_suppkey AS varchar) AS "teamId", l_returnflag AS "teamName", CAST(l_linenumber % 2 AS varchar) AS "isHomeTeam"'
FK_TEAM = "CAST(l_suppkey AS varchar) AS team_id, CAST(l_linenumber % 2 AS varchar) AS is_home_team"


def raw_event_sql(n: str) -> str:
    return (f'CAST(l_partkey + {n} AS varchar) AS "statId", CAST(l_linenumber AS varchar) AS "gameTime", '
            'CAST(NULL AS varchar) AS "utcTime"')


STATS_ROWS, FLOW_ROWS = "FROM lineitem WHERE l_linenumber <= 3", "FROM lineitem, {0} WHERE l_linenumber > 3"
E = TWO.format("e")
for _suffix, _sql in {
    "gamestats_gameinfo": f"""SELECT CAST(l_orderkey AS varchar) AS "gameId", l_linestatus AS "gameState", {ME_GAME} {STATS_ROWS}""",
    "gamestats_team": f"""SELECT CAST(l_suppkey AS varchar) AS "teamId", '4' AS score_points, '1' AS team_stats_tries, {ME_GAME}
                          {STATS_ROWS}""",
    "gamestats_team_player": f"""
        SELECT CAST(l_partkey + e AS varchar) AS "playerId", CAST(l_orderkey % 30 AS varchar) AS player_stats_tackles,
               CAST(l_suppkey AS varchar) AS team_id, {ME_GAME}
        FROM lineitem, {E} WHERE l_linenumber <= 3 AND (e = 0 OR l_orderkey % 2 = 1)""",
    "eventflow_score_event_team": f"""SELECT {RAW_TEAM}, CAST(l_orderkey % 50 AS varchar) AS points, {ME_FLOW}
                                      FROM lineitem WHERE l_linenumber > 3""",
    "eventflow_score_event_team_statscoringevent": f"""SELECT {raw_event_sql('e')}, {FK_TEAM}, {ME_FLOW}
        {FLOW_ROWS.format(E)} AND (e = 0 OR l_orderkey % 2 = 1)""",
    **{f"eventflow_{k}_event": f"""SELECT {raw_event_sql('e')}, {ME_FLOW} {FLOW_ROWS.format(E)}
        AND (e = 0 OR l_orderkey % 2 = 1)""" for k in ("possession", "penalty", "error", "scrum")},
    "eventflow_interchange": f"""
        SELECT CAST(e AS varchar) AS number, CASE WHEN e = 0 THEN CAST(l_partkey AS varchar) END AS "on_playerId",
               CAST(l_orderkey AS varchar) AS "off_playerId", '9' AS "off_shirtNum", {FK_TEAM}, {ME_FLOW}
        {FLOW_ROWS.format(E)} AND (e = 0 OR l_orderkey % 2 = 1)""",
    "eventflow_discipline": f"""
        SELECT CAST(e AS varchar) AS yellow, CAST(l_partkey AS varchar) AS "playerId", {FK_TEAM}, {ME_FLOW}
        {FLOW_ROWS.format(E)} AND l_orderkey % 5 <> 0 AND (e = 0 OR l_orderkey % 2 = 1)""",
    "eventflow_commentary_event": f"SELECT {raw_event_sql('0')}, {ME_FLOW} FROM lineitem WHERE l_linenumber > 3",
    "eventflow_colour_event": f"SELECT {raw_event_sql('0')}, {ME_FLOW} FROM lineitem WHERE l_linenumber > 3",
    "gamestats": """
        SELECT CAST(l_orderkey AS varchar) AS game_id, max(l_shipdate) AS ingested_at FROM lineitem
        WHERE l_linenumber <= 3 GROUP BY 1""",
}.items():
    domain_query(f"matchstatsandevents_{_suffix}", match_events_bronze, "matchstatsandevents", _suffix, _sql,
                 ("game_id", "ingested_at") if _suffix == "gamestats" else ())


# Match data --------------------------------------------------------------------------------------

def match_data_bronze(spark, sf):
    def player(i: int) -> dict:
        return {"playerId": text(f"l_partkey + {i}"), "playerStats": {"tackles": text("l_orderkey % 30")}}

    def caster(i: int) -> dict:
        return {"broadcasterID": text(f"l_suppkey + {i}"), "broadcaster": "l_linestatus"}

    region = {"regionid": text("l_linenumber"), "regionName": "l_returnflag", "broadcasters": {"broadcaster": Either(
        ONE_OR_TWO, caster(0), [caster(0), caster(1), "'only text'"])}}
    info = {"regions": {"region": Either("l_orderkey % 3 = 0", region, [region])}}
    one = {"teamId": text("l_suppkey"), "score": {"points": text("l_orderkey % 40")},
           "teamCoaches": {"teamCoach": {"coachId": text("l_partkey")}},
           "teamLineup": {"teamPlayer": one_or_two(player), "insAndOuts": {"insOuts": [{"playerId": "'i'"}, {"playerId": "'o'"}]}}}
    game = {"gameId": text("concat(l_orderkey, '-', l_linenumber, '-', l_partkey)"), "competitionId": "l_returnflag",
            "seasonId": "'s'"}
    return bronze_rows(
        table(spark, sf, "lineitem"), "concat_ws('_', 'match_stats', l_orderkey, l_linenumber, l_partkey)", "l_shipdate",
        {"gameInfo": ("l_linenumber <= 3", Either("l_linenumber = 1", {"broadcastInfo": info}, Either(
            "l_linenumber = 2", [{"broadcastInfo": info}], {"city": "'x'"}))),
         "teams": ("l_linenumber > 3", Either("l_linenumber = 4", {"teamsMatch": one}, [{"teamsMatch": [one]}]))},
        l0=Either("l_linenumber = 3", {**game, "broadcastInfo": info}, game))


MD = (f"CAST(l_orderkey || '-' || l_linenumber || '-' || l_partkey AS varchar) AS game_id, l_returnflag AS competition_id, "
      f"'s' AS season_id, 'match_stats_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS ingested_from")
for _suffix, _sql in {
    "broadcaster": f"""
        SELECT CAST(l_suppkey + e AS varchar) AS broadcaster_id, l_linestatus AS broadcaster,
               CAST(l_linenumber AS varchar) AS region_id, l_returnflag AS region_name, {MD}, {AT}
        FROM lineitem, {E} WHERE l_linenumber <= 3 AND (e = 0 OR l_orderkey % 2 = 1)""",
    "teams_team_player": f"""
        SELECT CAST(l_partkey + e AS varchar) AS "playerId", CAST(l_orderkey % 30 AS varchar) AS player_stats_tackles,
               CAST(l_suppkey AS varchar) AS team_id, {MD}, {AT}
        FROM lineitem, {E} WHERE l_linenumber > 3 AND (e = 0 OR l_orderkey % 2 = 1)""",
    # Line items repeat a key now and then; their competitions differ, so it is left out where keys decide.
    "teams_match": f"""
        SELECT DISTINCT team_id, score_points, game_id, season_id, ingested_from FROM (
          SELECT CAST(l_suppkey AS varchar) AS team_id, CAST(l_orderkey % 40 AS varchar) AS score_points,
                 {MD} FROM lineitem WHERE l_linenumber > 3)""",
    "team_coach": f"""SELECT DISTINCT coach_id, team_id, game_id, season_id, ingested_from FROM (
          SELECT CAST(l_partkey AS varchar) AS coach_id, CAST(l_suppkey AS varchar) AS team_id, {MD} FROM lineitem WHERE l_linenumber > 3)""",
    "ins_outs": f"""SELECT DISTINCT player_id, team_id, game_id, season_id, ingested_from FROM (
          SELECT p AS player_id, CAST(l_suppkey AS varchar) AS team_id, {MD}
          FROM lineitem, (SELECT unnest(['i', 'o']) AS p) WHERE l_linenumber > 3)""",
    "gameinfo": f"""
        SELECT DISTINCT game_id, season_id, ingested_from, city FROM (
          SELECT {MD}, CASE WHEN l_linenumber = 3 THEN 'x' END AS city FROM lineitem WHERE l_linenumber <= 3)""",
}.items():
    _cols = {"teams_match": ("score_points", "team_id"), "team_coach": ("coach_id", "team_id"),
             "ins_outs": ("player_id", "team_id"), "gameinfo": ("city",)}.get(_suffix)
    domain_query(f"matchdata_{_suffix}", reloaded(match_data_bronze) if _cols else match_data_bronze, "matchdata", _suffix, _sql,
                 (*_cols, "game_id", "season_id", "ingested_from") if _cols else ())


domain_query("matchdata_teams", reloaded(match_data_bronze), "matchdata", "teams", f"""
    SELECT DISTINCT game_id, season_id, ingested_from FROM (SELECT {MD} FROM lineitem WHERE l_linenumber > 3)""",
             ("game_id", "season_id", "ingested_from"))
domain_query("matchstatsandevents_eventflow", match_events_bronze, "matchstatsandevents", "eventflow", f"""
    SELECT CAST(l_orderkey AS varchar) AS game_id, max(l_shipdate) AS ingested_at, 'match_stats_and_events_' || l_orderkey AS ingested_from, 's' AS season_id
    FROM lineitem WHERE l_linenumber > 3 GROUP BY ALL""", ("game_id", "ingested_at", "ingested_from", "season_id"))


# Round breakdown -------------------------------------------------------------------------------------

def breakdown_bronze(spark, sf):
    def stats(i: int) -> dict:
        return {"periodId": f"'{i}'", "tries": text(f"l_orderkey % 9 + {i}")}

    def player(i: int) -> dict:
        return {"playerId": text(f"l_partkey + {i}"), "shirtNum": f"'{i}'", "playerStats": {
            "matchStats": Either("l_linenumber % 2 = 0", stats(0), {}), "periodStats": [stats(1), stats(2)]}}

    one = {"teamId": text("l_suppkey"), "teamAbbr": "l_returnflag", "score": Either(ONE_OR_TWO, {"points": "'3'"}, {}),
           "teamLineup": {"teamLineUpStatusID": "'1'", "teamLineUpStatus": "'final'", "teamPlayer": one_or_two(player)},
           "teamStats": {"matchStats": stats(0), "periodStats": stats(1)},
           "teamCoaches": {"teamCoach": one_or_two(lambda i: {"coachId": text(f"l_partkey + {i}")})}}
    return bronze_rows(
        table(spark, sf, "lineitem"),
        "concat_ws('_', 'match_data_by_round_breakdown', l_returnflag, year(l_shipdate), l_linenumber, l_suppkey, l_orderkey)",
        "l_shipdate",
        {"teams": ("true", Either("l_orderkey % 3 = 0", {"teamsMatch": [one]}, Either("l_orderkey % 3 = 1", [one], one))),
         "gameInfo": ("l_linenumber <= 2", {"crowd": text("month(l_shipdate)"), "broadcastInfo": {"x": "1"}})},
        l0={"gameState": text("month(l_shipdate)"), "roundName": "'r'"})


RB = (f"'match_data_by_round_breakdown_' || concat_ws('_', l_returnflag, year(l_shipdate), l_linenumber, l_suppkey, l_orderkey) "
      f"AS ingested_from, {AT}, l_returnflag AS competition_id, CAST(year(l_shipdate) AS varchar) AS season_id, "
      "CAST(l_linenumber AS varchar) AS round_id, CAST(l_suppkey AS varchar) AS game_num, CAST(l_orderkey AS varchar) AS game_id")
RB_TEAM = f"CAST(l_suppkey AS varchar) AS team_id, {RB}"
RB_PLAYER = f"CAST(l_partkey + p AS varchar) AS player_id, {RB_TEAM}"
RB_KEY = "l_returnflag, year(l_shipdate), l_linenumber, l_orderkey"
RB_FIRST = f"QUALIFY row_number() OVER (PARTITION BY {RB_KEY} ORDER BY l_shipdate, ingested_from) = 1"
PLAYERS = f"FROM lineitem, {TWO.format('p')} WHERE (p = 0 OR l_orderkey % 2 = 1)"
for _suffix, _sql in {
    "": f"""SELECT {RB}, CAST(NULL AS varchar) AS competition_name, CAST(month(l_shipdate) AS varchar) AS game_state,
            CAST(NULL AS varchar) AS game_state_id, 'r' AS round_name FROM lineitem {RB_FIRST}""",
    "game_info": f"SELECT CAST(month(l_shipdate) AS varchar) AS crowd, {RB} FROM lineitem WHERE l_linenumber <= 2 {RB_FIRST}",
    "team": f"SELECT l_returnflag AS team_abbr, {RB_TEAM} FROM lineitem",
    "team_score": f"SELECT '3' AS points, {RB_TEAM} FROM lineitem WHERE l_orderkey % 2 = 0",
    "team_lineup": f"""SELECT CAST(p AS varchar) AS shirt_num, '1' AS lineup_status_id, 'final' AS lineup_status, {RB_PLAYER}
                       {PLAYERS}""",
    "player_stats": f"""SELECT '0' AS period_id, CAST(l_orderkey % 9 AS varchar) AS tries, {RB_PLAYER}
                        {PLAYERS} AND l_linenumber % 2 = 0""",
    "player_period_stats": f"""
        SELECT CAST(s AS varchar) AS period_id, CAST(l_orderkey % 9 + s AS varchar) AS tries, {RB_PLAYER}
        FROM lineitem, {TWO.format('p')}, (SELECT unnest([1, 2]) AS s) WHERE (p = 0 OR l_orderkey % 2 = 1)""",
    "team_stats": f"SELECT '0' AS period_id, CAST(l_orderkey % 9 AS varchar) AS tries, {RB_TEAM} FROM lineitem",
    "team_period_stats": f"SELECT '1' AS period_id, CAST(l_orderkey % 9 + 1 AS varchar) AS tries, {RB_TEAM} FROM lineitem",
    "team_coach": f"SELECT CAST(l_partkey + p AS varchar) AS coach_id, {RB_TEAM} {PLAYERS}",
}.items():
    domain_query(f"roundbreakdown_{_suffix or 'root'}", breakdown_bronze, "matchdatabyroundbreakdown", _suffix, _sql)


# XY feed -------------------------------------------------------------------------------------------------

def xy_bronze(spark, sf):
    def xy(i: int) -> dict:
        return {"SI": text(f"l_partkey + {i}"), "SN": "l_returnflag", "EX": text("l_suppkey"), "T": f"'{i}'"}

    one = {**TEAM, "xandYFeed1stHalf": {"stat": [xy(0), xy(1), xy(1)]},
           "xandYFeed2ndHalf": {"stat": Either(ONE_OR_TWO, xy(2), [])}}
    return bronze_rows(table(spark, sf, "lineitem"), "concat_ws('_', 'live_xy', l_orderkey, l_linenumber, l_partkey)", "l_shipdate",
                       {"teams": ("true", {"team": [one]}), "videos": ("l_orderkey % 3 = 0", {})},
                       l0={"gameId": text("l_orderkey")})


XY_ID = "'live_xy_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS ingested_from, l_shipdate AS ingested_at"
XY_ABSENT = ", ".join(f"CAST(NULL AS varchar) AS {c}" for c in XY_FIELDS if c not in ("si", "sn", "ex", "t"))
domain_query("livexy_teams_stat", xy_bronze, "livexy", "teams_stat", f"""
    SELECT DISTINCT {XY_ID}, {TEAM_SQL}, CASE WHEN e < 2 THEN 1 ELSE 2 END AS feed_period,
           CAST(l_partkey + e AS varchar) AS si, l_returnflag AS sn, CAST(l_suppkey AS varchar) AS ex, CAST(e AS varchar) AS t, {XY_ABSENT}
    FROM lineitem, (SELECT unnest([0, 1, 2]) AS e) WHERE e < 2 OR l_orderkey % 2 = 0""")
domain_query("livexy_team", xy_bronze, "livexy", "team", """
    SELECT DISTINCT CAST(l_orderkey AS varchar) AS game_id, CAST(l_suppkey AS varchar) AS team_id FROM lineitem""",
             ("game_id", "team_id"))
domain_query("livexy_teams", xy_bronze, "livexy", "teams", f"""
    SELECT game_id, ingested_from, max(ingested_at) AS ingested_at
    FROM (SELECT CAST(l_orderkey AS varchar) AS game_id, {XY_ID} FROM lineitem) GROUP BY ALL""")
