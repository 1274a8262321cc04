"""Player statistics, team statistics, coaches and form guide, with payloads made from orders."""

from __future__ import annotations

from payloom.suite.base import Either, bronze_rows, domain_query, table, text

YEAR = "year(o_orderdate)"
AT = "CAST(o_orderdate AS varchar) AS ingested_at"
TWO = "(SELECT unnest([0, 1]) AS {0}) {0}"


def id_sql(prefix: str, *more: str) -> str:
    values = ["o_orderstatus", YEAR, *more]
    return " || ".join([f"'{prefix}'", *[f"'_' || {v}" for v in values]])


def id_expr(prefix: str, *more: str) -> str:
    return f"concat_ws('_', '{prefix}', o_orderstatus, {', '.join([YEAR, *more])})"


def context(prefix: str, season: str | None = YEAR, **more: str) -> str:
    cols = [f"{id_sql(prefix, *more.values())} AS ingested_from", AT, "o_orderstatus AS competition_id"]
    if season:
        cols.append(f"CAST({season} AS varchar) AS season_id")
    cols += [f"CAST({v} AS varchar) AS {k}" for k, v in more.items() if not k.startswith("_")]
    return ", ".join(cols)


def first_sql(select: str, keys: str, where: str = "true") -> str:
    return f"""SELECT {select} FROM orders WHERE {where}
               QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY o_orderdate, o_orderkey) = 1"""


# Player statistics ----------------------------------------------------------------

def team(i: int) -> dict:
    return {"teamId": text(f"o_custkey + {i}"), "teamName": "o_orderpriority", "isCurrentTeam": "'true'",
            "teamStatsTotal": {"tries": text(f"o_orderkey % 5 + {i}")}, "teamStatsAverage": {"tries": "'1.5'"}}


def season(i: int) -> dict:
    rounds = [{"roundNumber": "'1'", "gameID": text(f"o_orderkey + {i}")}, {"roundNumber": "'2'", "gameID": "'g'"}]
    return {"seasonId": text(f"{YEAR} + 1") if i == 0 else "''",
            "seasonStatsTotal": {"points": text(f"o_orderkey % 7 + {i}"), "roundStats": {"round": Either(
                "o_orderkey % 2 = 0", rounds[0], rounds)}},
            "seasonStatsAverage": {"points": "'2.5'"}, "teams": {"team": team(i)}}


PLAYER = {
    "playerId": text("o_orderkey"), "playerName": "o_orderpriority", "teamId": "'t'",
    "career": {
        "careerStatsTotal": {"tries": text("o_orderkey % 10"), "points": text("o_custkey")},
        "careerStatsAverage": Either("o_orderkey % 2 = 0", {"tries": "'0.5'"}, {}),
        "teams": Either("o_orderkey % 3 = 0", {"team": team(0)}, Either(
            "o_orderkey % 3 = 1", {"team": [team(0), team(1)]}, [team(0), team(1)]))},
    "season": Either("o_orderkey % 2 = 0", season(0), [season(0), season(1)]),
}


def players_bronze(prefix: str):
    def make(spark, sf):
        payload = Either("o_orderkey % 3 = 0", {"player": PLAYER}, Either("o_orderkey % 3 = 1", {"player": [PLAYER]}, [PLAYER]))
        return bronze_rows(
            table(spark, sf, "orders"), id_expr(prefix), "o_orderdate",
            {"players": ("true", payload),
             "competitionPlayerAverageStats": ("o_orderkey % 5 = 0", {"avgTries": text("month(o_orderdate)"), "x": {"y": "1"}})},
            l0={"competitionName": "concat('c', o_orderstatus)", "competitionId": "'l0'"})

    return make


def player_queries(pipe: str, prefix: str, avg: str, career: str, in_season: str) -> None:
    make = players_bronze(prefix)
    ctx, player = context(prefix), "CAST(o_orderkey AS varchar) AS player_id"
    no_season = context(prefix, None)
    own_season = f"CAST(CASE WHEN s = 0 THEN {YEAR} + 1 ELSE {YEAR} END AS varchar) AS season_id"
    seasons = f"orders, {TWO.format('s')} WHERE (s = 0 OR o_orderkey % 2 = 1)"
    teams = f"orders, {TWO.format('t')} WHERE (t = 0 OR o_orderkey % 3 > 0)"

    def team_cols(prefix_: str, n: str) -> str:
        return (f"CAST(o_custkey + {n} AS varchar) AS {prefix_}team_id, o_orderpriority AS {prefix_}team_name, "
                "'true' AS is_current_team")

    sql = {
        "player": f"SELECT {player}, o_orderpriority AS player_name, 't' AS team_id, {ctx} FROM orders",
        "career_total": f"""SELECT CAST(o_orderkey % 10 AS varchar) AS tries, CAST(o_custkey AS varchar) AS points,
                            {player}, {ctx} FROM orders""",
        "career_average": f"SELECT '0.5' AS tries, {player}, {ctx} FROM orders WHERE o_orderkey % 2 = 0",
        "career_team_total": f"""SELECT CAST(o_orderkey % 5 + t AS varchar) AS tries, {team_cols(career, 't')},
                                 {player}, {ctx} FROM {teams}""",
        f"career_team_{avg}": f"SELECT '1.5' AS tries, {team_cols(career, 't')}, {player}, {ctx} FROM {teams}",
        "season_total": f"""SELECT CAST(o_orderkey % 7 + s AS varchar) AS points, {own_season}, {player}, {no_season}
                            FROM {seasons}""",
        "season_average": f"SELECT '2.5' AS points, {own_season}, {player}, {no_season} FROM {seasons}",
        "season_team_total": f"""SELECT CAST(o_orderkey % 5 + s AS varchar) AS tries, {team_cols(in_season, 's')},
                                 {own_season}, {player}, {no_season} FROM {seasons}""",
        f"season_team_{avg}": f"""SELECT '1.5' AS tries, {team_cols(in_season, 's')}, {own_season}, {player}, {no_season}
                                  FROM {seasons}""",
        "round": f"""SELECT CAST(r + 1 AS varchar) AS round_number,
                     CASE WHEN r = 0 THEN CAST(o_orderkey + s AS varchar) ELSE 'g' END AS game_id,
                     {own_season}, {player}, {no_season}
                     FROM orders, {TWO.format('s')}, {TWO.format('r')}
                     WHERE (s = 0 OR o_orderkey % 2 = 1) AND (r = 0 OR o_orderkey % 2 = 1)""",
        "": first_sql(f"{ctx}, 'c' || o_orderstatus AS competition_name", f"o_orderstatus, {YEAR}"),
    }
    if pipe == "playerstatsv2":
        sql["competition_average"] = first_sql(
            f"CAST(month(o_orderdate) AS varchar) AS avg_tries, {ctx}", f"o_orderstatus, {YEAR}", "o_orderkey % 5 = 0")
    for suffix, text_ in sql.items():
        domain_query(f"{pipe}_{suffix or 'root'}", make, pipe, suffix, text_)


player_queries("playerstatsv2", "player_stats_v2", "average", "career_", "season_")
player_queries("playerstatsmaster", "historical_stats_by_round", "avg", "", "")


# Team statistics --------------------------------------------------------------------

BLOCKS = ("currentRoundStats", "seasonStats", "seasonAverageStats", "historicalStats", "historicalAverageStats")
TEAM = {"teamId": text("o_custkey"), "teamName": "o_orderpriority"}


def team_stats_bronze(spark, sf):
    one = {**TEAM, "teamLogoURL": "'u'", "teamHexColour": "'#1'", "teamHexColour2": "'#2'",
           **{b: {"tries": text(f"o_orderkey + {i}"), "kind": f"'{b}'"} for i, b in enumerate(BLOCKS[:3])},
           "historicalStats": {}}
    return bronze_rows(
        table(spark, sf, "orders"), id_expr("team_stats", "month(o_orderdate)"), "o_orderdate",
        {"teams": ("true", Either("o_orderkey % 2 = 0", {"team": one}, [one])),
         "competitionTeamAverageStats": ("o_orderkey % 5 = 0", {"tries": text("day(o_orderdate)")})},
        l0={"competitionName": "concat('c', o_orderstatus)"})


TS = context("team_stats", round_number="month(o_orderdate)")
TS_KEY = f"o_orderstatus, {YEAR}, month(o_orderdate)"
domain_query("teamstats_teams", team_stats_bronze, "teamstats", "teams",
             first_sql(f"{TS}, 'c' || o_orderstatus AS competition_name", TS_KEY))
domain_query("teamstats_team", team_stats_bronze, "teamstats", "team", f"""
    SELECT CAST(o_orderkey + b AS varchar) AS tries, k AS kind, k AS stat_type, CAST(o_custkey AS varchar) AS team_id,
           o_orderpriority AS team_name, 'u' AS team_logo_url, '#1' AS team_hex_colour, '#2' AS team_hex_colour2, {TS}
    FROM orders, (SELECT unnest([0, 1, 2]) AS b, unnest(['currentRoundStats', 'seasonStats', 'seasonAverageStats']) AS k)""")
domain_query("teamstats_comp_avg", team_stats_bronze, "teamstats", "comp_avg",
             first_sql(f"CAST(day(o_orderdate) AS varchar) AS tries, {TS}", TS_KEY, "o_orderkey % 5 = 0"))


def team_stats_v2_bronze(spark, sf):
    def rnd(i: int) -> dict:
        return {"roundNumber": f"'{i}'", "gameID": text(f"o_orderkey + {i}")}

    one = {**TEAM, "seasonStats": {"tries": text("o_orderkey"), "rounds": Either(
               "o_orderkey % 3 = 0", {"round": rnd(1)}, Either("o_orderkey % 3 = 1", {"round": [rnd(1), rnd(2)]}, [rnd(1)]))},
           "seasonAverageStats": {"tries": "'0.1'"}, "historicalStats": {"tries": text("o_orderkey % 9")},
           "historicalAverageStats": Either("o_orderkey % 2 = 0", {"tries": "'0.2'"}, {})}
    return bronze_rows(
        table(spark, sf, "orders"), id_expr("team_stats_v2"), "o_orderdate",
        {"teams": ("true", Either("o_orderkey % 2 = 0", {"team": one}, [one])),
         "competitionTeamAverageStats": ("o_orderkey % 5 = 0", {"tries": text("day(o_orderdate)")})},
        l0=Either("o_orderkey % 2 < 2", {"competitionName": "concat('c', o_orderstatus)"}, None))


V2 = context("team_stats_v2")
V2_TEAM = f"CAST(o_custkey AS varchar) AS team_id, {V2}"
for _suffix, _sql in {
    "": first_sql(f"{V2}, 'c' || o_orderstatus AS competition_name", f"o_orderstatus, {YEAR}"),
    "competition_average": first_sql(f"CAST(day(o_orderdate) AS varchar) AS tries, {V2}", f"o_orderstatus, {YEAR}",
                                     "o_orderkey % 5 = 0"),
    "season_total": f"SELECT CAST(o_orderkey AS varchar) AS tries, {V2_TEAM} FROM orders",
    "season_average": f"SELECT '0.1' AS tries, {V2_TEAM} FROM orders",
    "historical_total": f"SELECT CAST(o_orderkey % 9 AS varchar) AS tries, {V2_TEAM} FROM orders",
    "historical_average": f"SELECT '0.2' AS tries, {V2_TEAM} FROM orders WHERE o_orderkey % 2 = 0",
    "round": f"""SELECT CAST(r AS varchar) AS round_number, CAST(o_orderkey + r AS varchar) AS game_id, {V2_TEAM}
                 FROM orders, (SELECT unnest([1, 2]) AS r) WHERE r = 1 OR o_orderkey % 3 = 1""",
}.items():
    domain_query(f"teamstatsv2_{_suffix or 'root'}", team_stats_v2_bronze, "teamstatsv2", _suffix, _sql)
domain_query("teamstatsv2_team", team_stats_v2_bronze, "teamstatsv2", "team", """
    SELECT DISTINCT CAST(o_custkey AS varchar) AS team_id, o_orderstatus AS competition_id FROM orders""",
             ("team_id", "competition_id"))


# Coaches ------------------------------------------------------------------------------

def coaches_bronze(spark, sf):
    def coach(i: int) -> dict:
        return {"coachId": text(f"o_orderkey + {i}"), "fullName": "o_orderpriority", "dob": "cast(null as string)"}

    one = {**TEAM, "coaches": Either("o_orderkey % 3 = 0", {"coach": coach(0)}, Either(
        "o_orderkey % 3 = 1", {"coach": [coach(0), coach(1)]}, [coach(0)]))}
    return bronze_rows(
        table(spark, sf, "orders"), id_expr("coaches"), "o_orderdate",
        {"teams": ("true", Either("o_orderkey % 2 = 0", {"team": [one]}, one)), "other": ("o_orderkey % 9 = 0", {"x": "1"})},
        l0={"competitionName": "concat('c', o_orderstatus)"})


CO = context("coaches")
domain_query("coaches_root", coaches_bronze, "coaches", "",
             first_sql(f"{CO}, 'c' || o_orderstatus AS competition_name", f"o_orderstatus, {YEAR}"))
domain_query("coaches_coach", coaches_bronze, "coaches", "coach", f"""
    SELECT CAST(o_orderkey + c AS varchar) AS coach_id, o_orderpriority AS full_name, CAST(NULL AS varchar) AS dob,
           CAST(o_custkey AS varchar) AS team_id, o_orderpriority AS team_name, {CO}
    FROM orders, {TWO.format('c')} WHERE c = 0 OR o_orderkey % 3 = 1""")


# Form guide -----------------------------------------------------------------------------

def form_guide_bronze(spark, sf):
    one = {
        "teamId": text("o_custkey"), "teamName": "o_orderpriority", "isHomeTeam": "'1'", "teamPosition": text("o_orderkey % 16"),
        "headToHead": Either("o_orderkey % 2 = 0", {"odds": text("o_orderkey % 8")}, {}),
        "recentRecord": {"recentGame": Either("o_orderkey % 2 = 0", {"score": "'1'"}, [{"score": "'1'"}, {"score": "'2'"}])},
        "seasonHomeAndAwayAverages": {"home": {"tries": text("o_orderkey % 4")}, "away": {"tries": text("o_orderkey % 6")}},
        "seasonPlayerStats": {"playerGame": [
            {"playerId": text("o_orderkey"), "playerName": "'p'", "appearances": "'3'",
             "averageStats": {"tries": "'1'", "runs": "'5'"},
             "maxStats": Either("o_orderkey % 2 = 0", {"tries": "'2'"}, {"runs": "'7'"}), "totalStats": {"tries": "'9'"}},
            {"playerId": text("o_orderkey + 1"), "playerName": "'q'", "appearances": "'4'"}]},
        "seasonTeamStats": {"wins": text("o_orderkey % 3")},
        "seasonWinLossBreakdown": {"winWin": "'7'"},
        "teamList": {"playerLineup": {"playerId": text("o_orderkey"), "shirtNum": "'6'"}},
    }
    meeting = {"gameId": "'old'", "matchSummary": "o_orderpriority"}
    return bronze_rows(
        table(spark, sf, "orders"), id_expr("form_guide_for_match", "o_orderkey"), "o_orderdate",
        {"teamFormGuideStats": ("true", Either("o_orderkey % 3 = 0", {"teamFormGuideStats": [one]}, Either(
            "o_orderkey % 3 = 1", [one], one))),
         "lastTenMeetings": ("o_orderkey % 2 = 0", Either("o_orderkey % 4 = 0", {"game": [meeting, meeting]}, [meeting]))},
        l0={"gameHashTag": "o_orderpriority", "competitionId": "'l0'", "roundId": text("o_custkey")})


FG = context("form_guide_for_match", game_id="o_orderkey")
FG_TEAM = f"CAST(o_custkey AS varchar) AS team_id, o_orderpriority AS team_name, '1' AS is_home_team, {FG}"
for _suffix, _sql in {
    "": f"SELECT o_orderpriority AS game_hash_tag, CAST(o_custkey AS varchar) AS round_id, {FG} FROM orders",
    "last_ten_meeting": f"""SELECT o_orderpriority AS match_summary, {FG} FROM orders, {TWO.format('m')}
                            WHERE o_orderkey % 2 = 0 AND (m = 0 OR o_orderkey % 4 = 0)""",
    "team": f"SELECT CAST(o_orderkey % 16 AS varchar) AS team_position, {FG_TEAM} FROM orders",
    "h2h": f"SELECT CAST(o_orderkey % 8 AS varchar) AS odds, {FG_TEAM} FROM orders WHERE o_orderkey % 2 = 0",
    "team_recent_game": f"""SELECT CAST(g + 1 AS varchar) AS score, {FG_TEAM} FROM orders, {TWO.format('g')}
                            WHERE g = 0 OR o_orderkey % 2 = 1""",
    "season_home_away_averages": f"""
        SELECT CAST(o_orderkey % 4 AS varchar) AS tries, 'home' AS team_side, {FG_TEAM} FROM orders UNION ALL
        SELECT CAST(o_orderkey % 6 AS varchar), 'away', {FG_TEAM} FROM orders""",
    "team_player_stats": f"""
        SELECT CAST(o_orderkey + p AS varchar) AS player_id, CASE p WHEN 0 THEN 'p' ELSE 'q' END AS player_name,
               CAST(3 + p AS varchar) AS appearances, {FG_TEAM} FROM orders, {TWO.format('p')}""",
    # A maximum takes the place of an average only where there is one.
    "player_game_stats": f"""SELECT CAST(o_orderkey AS varchar) AS player_id, 'p' AS player_name,
                             CASE WHEN o_orderkey % 2 = 0 THEN '2' ELSE '1' END AS tries,
                             CASE WHEN o_orderkey % 2 = 0 THEN '5' ELSE '7' END AS runs, '9' AS total_tries, {FG_TEAM} FROM orders""",
    "season_team_stats": f"SELECT CAST(o_orderkey % 3 AS varchar) AS wins, {FG_TEAM} FROM orders",
    "season_win_loss_breakdown": f"SELECT '7' AS win_win, {FG_TEAM} FROM orders",
    "player_line_up": f"SELECT CAST(o_orderkey AS varchar) AS player_id, '6' AS shirt_num, {FG_TEAM} FROM orders",
}.items():
    domain_query(f"formguide_{_suffix or 'root'}", form_guide_bronze, "formguideformatch", _suffix, _sql)


domain_query("formguide_team_form_guide_stats", form_guide_bronze, "formguideformatch", "team_form_guide_stats", """
    SELECT CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS varchar) END AS team_id, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS team_name,
           CASE WHEN o_orderkey % 3 > 0 THEN '1' END AS is_home_team, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 16 AS varchar) END AS team_position,
           {0}, 'l0' AS competition_id, CAST(o_custkey AS varchar) AS round_id FROM orders""".format(
               FG.split(" AS ingested_from")[0] + " AS ingested_from, o_orderdate AS ingested_at"))
