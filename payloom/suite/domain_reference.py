"""Ladders, entity lists, squads, profiles, seasons and fixtures, with payloads made from small and wide tables."""

from __future__ import annotations

from payloom.functions.text import snake_case
from payloom.operators.reshape import union_by_name
from payloom.plans.catalog.reference_data import ENTITY_SECTIONS
from payloom.suite.base import Either, Repeat, bronze_rows, domain_query, reloaded, table, text

AT = "CAST(o_orderdate AS varchar) AS ingested_at"
LATEST = "QUALIFY row_number() OVER (PARTITION BY {0} ORDER BY o_orderdate DESC, ingested_from) = 1"


# Ladders ----------------------------------------------------------------------------------

def ladder_bronze(name: str):
    def make(spark, sf):
        form = {"recentForm1": {"_text": "o_orderstatus"}, "recentForm2": {"_text": "o_orderpriority"}}
        payload = Either("o_orderkey % 2 = 0", [{**form, "recentForm12": {"_text": "'W'"}}], [form])
        return bronze_rows(table(spark, sf, "orders"), f"concat('{name}_', o_orderkey)", "o_orderdate",
                           {"ladderposition": ("true", payload)},
                           l0={"teamId": text("o_custkey"), "played": "o_orderkey % 25", "premiershipOdds": text("o_orderkey")})

    return make


for _name in ("ladder", "live_ladder"):
    _id = f"'{_name}_' || o_orderkey AS ingested_from"
    domain_query(f"{_name}_ladderposition", ladder_bronze(_name), _name, "ladderposition", f"""
        SELECT CAST(o_custkey AS varchar) AS team_id, o_orderkey % 25 AS played, CAST(o_orderkey AS varchar) AS premiership_odds,
               o_orderdate AS ingested_at, {_id} FROM orders {LATEST.format('o_custkey')}""")
    domain_query(f"{_name}_recent_form", ladder_bronze(_name), _name, "ladderposition_recent_form", f"""
        SELECT CAST(o_custkey AS varchar) AS team_id, n AS form_order,
               CASE n WHEN 1 THEN o_orderstatus WHEN 2 THEN o_orderpriority ELSE 'W' END AS result,
               o_orderdate AS ingested_at, {_id}
        FROM orders, (SELECT unnest([1, 2, 12]) AS n) WHERE n < 12 OR o_orderkey % 2 = 0
        {LATEST.format('o_custkey, n')}""")


# Entity lists -------------------------------------------------------------------------------

# Section -> test table, id column, name column.
SECTION_TABLES = {
    "competitions": ("region", "r_regionkey", "r_name"), "venues": ("nation", "n_nationkey", "n_name"),
    "players": ("customer", "c_custkey", "c_name"), "teams": ("supplier", "s_suppkey", "s_name"),
    "positions": ("part", "p_partkey", "p_type"), "statistics": ("part", "p_partkey", "p_brand"),
    "groundConditions": ("nation", "n_nationkey", "n_name"), "weatherConditions": ("region", "r_regionkey", "r_name"),
    "scoringMethods": ("region", "r_regionkey", "r_name"), "gameStates": ("region", "r_regionkey", "r_name"),
    "officials": ("customer", "c_custkey", "c_name"), "seasons": ("nation", "n_nationkey", "n_name"),
    "rounds": ("part", "p_partkey", "p_name"), "fantasyRules": ("supplier", "s_suppkey", "s_name"),
}


def entities_bronze(section: str):
    """Rows of one section, among rows of another that must not get into its table."""
    def make(spark, sf):
        parts = []
        for name in {section: 1, "competitions": 1, "venues": 1}:
            source, key, label = SECTION_TABLES[name]
            one = {"id": text(key), "name": label, "competitionId": "'111'", "seasonId": text(f"{key} % 3")}
            parts.append(bronze_rows(
                table(spark, sf, source), f"concat_ws('_', 'entities', '{name}', {key})", "timestamp'2024-01-01'",
                {name: ("true", {ENTITY_SECTIONS[name][1]: Either(f"{key} % 2 = 0", one, [one])})}))
        return union_by_name(*parts)

    return make


for _section, (_table, _key, _label) in SECTION_TABLES.items():
    _entity = snake_case(ENTITY_SECTIONS[_section][1])
    domain_query(f"entities_{_entity}", reloaded(entities_bronze(_section)), "entities", _entity, f"""
        SELECT CAST({_key} AS varchar) AS id, {_label} AS name, '111' AS competition_id, CAST({_key} % 3 AS varchar) AS season_id,
               TIMESTAMP '2024-01-01' AS ingested_at, 'entities_{_section}_' || {_key} AS ingested_from FROM {_table}""")


# Squads, profiles and associations -----------------------------------------------------------

def squad_team(i: int) -> dict:
    return {"teamId": text(f"o_orderkey * 2 + {i}"), "teamHistory": {"wins": "o_orderkey % 9"},
            "coach": {"coachId": text(f"o_orderkey * 2 + {i}"), "first": "o_orderstatus"},
            "player": [{"playerId": text(f"o_orderkey * 4 + {2 * i}")}, {"playerId": text(f"o_orderkey * 4 + {2 * i + 1}")}]}


def all_squads_bronze(spark, sf):
    comp = {"competitionId": text("o_orderkey"), "team": [squad_team(0), squad_team(1)]}
    return bronze_rows(table(spark, sf, "orders"), "concat_ws('_', 'all_squads', o_orderkey)", "o_orderdate",
                       {"competitions": ("true", {"competition": [comp]})}, l0={"seasonId": text("year(o_orderdate)")})


SQ = ("CAST(year(o_orderdate) AS varchar) AS season_id, o_orderdate AS ingested_at, "
      "'all_squads_' || o_orderkey AS ingested_from")
SQ_COMP = f"CAST(o_orderkey AS varchar) AS competition_id, {SQ}"
SQ_TEAM = f"CAST(o_orderkey * 2 + t AS varchar) AS team_id, {SQ_COMP}"
TEAMS = "FROM orders, (SELECT unnest([0, 1]) AS t)"
for _suffix, _sql in {
    "competitions": f"SELECT {SQ} FROM orders",
    "competition": f"SELECT {SQ_COMP} FROM orders",
    "team": f"SELECT o_orderkey % 9 AS team_history_wins, {SQ_TEAM} {TEAMS}",
    "player": f"SELECT CAST(o_orderkey * 4 + 2 * t + p AS varchar) AS player_id, {SQ_TEAM} {TEAMS}, (SELECT unnest([0, 1]) AS p)",
    "coach": f"SELECT CAST(o_orderkey * 2 + t AS varchar) AS coach_id, o_orderstatus AS first, {SQ_TEAM} {TEAMS}",
}.items():
    domain_query(f"all_squads_{_suffix}", reloaded(all_squads_bronze), "all_squads", _suffix, _sql)


def squad_list_bronze(spark, sf):
    payload = {"team": Either("o_orderkey % 2 = 0", squad_team(0), [squad_team(0), squad_team(1)])}
    return bronze_rows(table(spark, sf, "orders"), "concat_ws('_', 'squad', o_orderstatus, year(o_orderdate), o_orderkey)",
                       "o_orderdate", {"teams": ("true", payload)},
                       l0={"competitionId": "o_orderstatus", "competitionEasyKickingSuccessRate": text("o_orderkey % 100")})


SL = ("o_orderstatus AS competition_id, o_orderdate AS ingested_at, "
      "'squad_' || o_orderstatus || '_' || year(o_orderdate) || '_' || o_orderkey AS ingested_from")
SL_TEAMS = f"{TEAMS} WHERE (t = 0 OR o_orderkey % 2 = 1)"
for _suffix, _sql in {
    "team": f"SELECT CAST(o_orderkey * 2 + t AS varchar) AS team_id, o_orderkey % 9 AS team_history_wins, {SL} {SL_TEAMS}",
    "player": f"""SELECT CAST(o_orderkey * 4 + 2 * t + p AS varchar) AS player_id, CAST(o_orderkey * 2 + t AS varchar) AS team_id,
                  {SL} FROM orders, (SELECT unnest([0, 1]) AS t), (SELECT unnest([0, 1]) AS p) WHERE (t = 0 OR o_orderkey % 2 = 1)""",
    "coach": f"""SELECT CAST(o_orderkey * 2 + t AS varchar) AS coach_id, o_orderstatus AS first,
                 CAST(o_orderkey * 2 + t AS varchar) AS team_id, {SL} {SL_TEAMS}""",
    "competition": f"""SELECT {SL.replace('o_orderdate AS ingested_at', AT)}, CAST(o_orderkey % 100 AS varchar)
                       AS competition_easy_kicking_success_rate, CAST(NULL AS varchar) AS competition_tough_kicking_success_rate,
                       CAST(NULL AS varchar) AS competition_name, CAST(NULL AS varchar) AS season_id FROM orders""",
}.items():
    domain_query(f"squad_list_{_suffix}", squad_list_bronze if _suffix == "competition" else reloaded(squad_list_bronze), "squad_list", _suffix, _sql)
domain_query("squad_list_teams", squad_list_bronze, "squad_list", "teams", f"SELECT {SL} FROM orders")


def player_profile_bronze(spark, sf):
    club = {"teamId": text("o_custkey % 20"), "games": "o_orderkey % 50"}
    return bronze_rows(table(spark, sf, "orders"), "concat_ws('_', 'player_profiles', o_orderkey)", "o_orderdate",
                       {"player": ("true", Either("o_orderkey % 2 = 0", {"teams": {"team": club}}, [{"teams": {"team": [club]}}]))},
                       l0={"playerId": text("o_custkey"), "careerAppearances": text("o_orderkey % 300")})


PP = "o_orderdate AS ingested_at, 'player_profiles_' || o_orderkey AS ingested_from"
domain_query("player_profile_player", player_profile_bronze, "player_profile", "player", f"""
    SELECT CAST(o_custkey AS varchar) AS player_id, CAST(o_orderkey % 300 AS varchar) AS career_appearances, {PP}
    FROM orders {LATEST.format('o_custkey')}""")
domain_query("player_profile_team", player_profile_bronze, "player_profile", "team", f"""
    SELECT CAST(o_custkey AS varchar) AS player_id, CAST(o_orderkey % 300 AS varchar) AS career_appearances,
           CAST(o_custkey % 20 AS varchar) AS team_id, o_orderkey % 50 AS games, {PP}
    FROM orders {LATEST.format('o_custkey')}""")


def associations_bronze(spark, sf):
    def team(i: int) -> dict:
        return {"teamId": text(f"o_custkey + {i}"), "teamName": "o_orderstatus", "positions": {}}

    season = {"seasonId": text("year(o_orderdate)"), "teams": {"team": Either("o_orderkey % 2 = 0", team(0), [team(0), team(1)])}}
    comp = {"competitionId": "'111'", "seasons": {"season": Either("o_orderkey % 3 = 0", season, [season])}}
    player = {"playerId": text("o_orderkey"), "competitions": {"competition": Either("o_orderkey % 5 = 0", [comp], comp)}}
    return bronze_rows(table(spark, sf, "orders"), "concat_ws('_', 'player_associations', o_orderkey)", "o_orderdate",
                       {"players": ("true", {"player": Either("o_orderkey % 7 = 0", player, [player])})})


PA = "o_orderdate AS ingested_at, 'player_associations_' || o_orderkey AS ingested_from, CAST(o_orderkey AS varchar) AS player_id"
PA_COMP = f"'111' AS competition_id, {PA}"
PA_SEASON = f"CAST(year(o_orderdate) AS varchar) AS season_id, {PA_COMP}"
for _suffix, _sql in {
    "player": f"SELECT {PA} FROM orders",
    "competition": f"SELECT {PA_COMP} FROM orders",
    "season": f"SELECT {PA_SEASON} FROM orders",
    "team": f"""SELECT CAST(o_custkey + t AS varchar) AS team_id, o_orderstatus AS team_name, {PA_SEASON}
                {TEAMS} WHERE t = 0 OR o_orderkey % 2 = 1""",
}.items():
    domain_query(f"player_associations_{_suffix}", reloaded(associations_bronze), "player_associations", _suffix, _sql)


# Seasons and fixtures: field names are kept as they are ----------------------------------------

def season_list_bronze(spark, sf):
    shape = {"id": text("o_orderkey"), "name": "o_orderstatus", "active": "o_orderkey % 2 = 0",
             "rounds": {"round": Repeat("o_orderkey % 3", {"id": "concat(o_orderkey, '-', i)", "roundName": "concat('Round ', i)"})},
             "clubs": {"club": {"teamId": text("o_custkey"), "nested": {"x": "1"}}},
             "coaches": {"coach": [{"coachId": text("o_custkey")}, {"coachId": text("o_custkey + 1")}]},
             "venues": {}, "officials": {"official": {"officialId": text("o_orderkey"), "firstName": "o_orderpriority"}}}
    return bronze_rows(table(spark, sf, "orders"), "concat_ws('_', 'season_list', o_orderkey)", "o_orderdate",
                       {"seasons": ("true", Either("o_orderkey % 4 = 0", {**shape, "venues": {"venue": {"venueId": "'v'"}}}, shape))},
                       l0={"competitionId": "'111'"})


SE = "CAST(o_orderkey AS varchar) AS season_id, 'season_list_' || o_orderkey AS ingested_from, o_orderdate AS ingested_at"
for _suffix, _sql in {
    "season": """SELECT CAST(o_orderkey AS varchar) AS id, o_orderstatus AS name, o_orderkey % 2 = 0 AS active,
                 '111' AS competition_id, o_orderdate AS ingested_at, 'season_list_' || o_orderkey AS ingested_from FROM orders""",
    "round": f"""SELECT o_orderkey || '-' || r AS id, 'Round ' || r AS "roundName", {SE}
                 FROM orders, (SELECT unnest([1, 2]) AS r) WHERE r <= o_orderkey % 3""",
    "club": f"""SELECT CAST(o_custkey AS varchar) AS "teamId", {SE} FROM orders""",
    "coach": f"""SELECT CAST(o_custkey + t AS varchar) AS "coachId", {SE} {TEAMS}""",
    "venue": f"""SELECT 'v' AS "venueId", {SE} FROM orders WHERE o_orderkey % 4 = 0""",
    "official": f"""SELECT CAST(o_orderkey AS varchar) AS "officialId", o_orderpriority AS "firstName", {SE} FROM orders""",
}.items():
    domain_query(f"season_list_{_suffix}", reloaded(season_list_bronze) if _suffix == "season" else season_list_bronze, "season_list", _suffix, _sql)


def fixtures_bronze(prefix: str):
    def caster(i: int) -> dict:
        return {"broadcasterID": f"'{i}'", "broadcaster": "o_orderstatus"}

    def make(spark, sf):
        region = {"regionid": "'au'", "broadcasters": {"broadcaster": Either("o_orderkey % 2 = 0", caster(1), [
            "'Nine'", caster(1), caster(2)])}}
        game = {"gameId": text("o_orderkey"), "city": "o_orderpriority",
                "teams": {"team": [{"teamId": text("o_custkey")}, {"teamId": text("o_custkey + 1")}]},
                "broadcastInfo": {"regions": {"region": Either("o_orderkey % 3 = 0", region, [region])}}}
        shape = {"roundId": text("o_orderkey"), "roundName": "'Round 1'", "roundAbbreviation": "'R1'",
                 "gameFixtures": Either("o_orderkey % 5 = 0", [game], {"gameFixture": Either("o_orderkey % 2 = 0", game, [game])}),
                 "teamByes": Either("o_orderkey % 4 = 0", {"teamBye": {"teamId": "'b'"}}, {})}
        return bronze_rows(table(spark, sf, "orders"), f"concat_ws('_', '{prefix}', o_orderkey)", "o_orderdate",
                           {"roundFixtures": ("true", shape)}, l0={"competitionId": "'111'"})

    return make


def fixture_sql(prefix: str) -> dict[str, str]:
    base = f"'{prefix}_' || o_orderkey AS ingested_from, o_orderdate AS ingested_at"
    rnd = f"CAST(o_orderkey AS varchar) AS round_id, 'Round 1' AS round_name, 'R1' AS round_abbreviation, {base}"
    game = f"CAST(o_orderkey AS varchar) AS game_id, {rnd}"
    region = f"'au' AS region_id, {game}"
    return {
        "roundfixtures": f"SELECT {rnd}, '111' AS competition_id FROM orders",
        "gamefixture": f"""SELECT CAST(o_orderkey AS varchar) AS "gameId", o_orderpriority AS city, {rnd} FROM orders""",
        "gamefixture_team": f"""SELECT CAST(o_custkey + t AS varchar) AS "teamId", {game} {TEAMS}""",
        "gamefixture_region": f"SELECT 'au' AS regionid, {game} FROM orders",
        "gamefixture_region_broadcaster": f"""
            SELECT CASE WHEN b > 0 THEN CAST(b AS varchar) END AS "broadcasterID",
                   CASE WHEN b > 0 THEN o_orderstatus ELSE 'Nine' END AS broadcaster, {region}
            FROM orders, (SELECT unnest([0, 1, 2]) AS b) WHERE b = 1 OR o_orderkey % 2 = 1""",
        "teambye": f"""SELECT 'b' AS "teamId", {rnd} FROM orders WHERE o_orderkey % 4 = 0""",
    }


for _pipe, _prefix in (("fixtures", "fixtures"), ("roundschedule", "round_fixtures")):
    for _suffix, _sql in fixture_sql(_prefix).items():
        _feed = fixtures_bronze(_prefix)
        domain_query(f"{_pipe}_{_suffix}", reloaded(_feed) if _suffix == "roundfixtures" else _feed, _pipe, _suffix, _sql)
