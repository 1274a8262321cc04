"""The ten dimensions, from flat tables made of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.operators.quality import union_results
from payloom.plans.dimensions import DIMENSIONS, build_dimension, dimension_checks
from payloom.suite.base import ORACLES, QUERIES, plain_time, query, table

NOW = "2024-06-01 00:00:00"


def build(name: str, sources: dict):
    df = build_dimension(DIMENSIONS[name], sources, F.lit(NOW).cast("timestamp"))
    return timed(df)


def timed(df):
    return plain_time(df, *[c for c in ("valid_from", "valid_to", "_loaded_at", "_updated_at", "_source_at") if c in df.columns])


def audit_sql(source: str, at: str | None = "TIMESTAMP '2024-01-01'") -> str:
    out = f"{source} AS _source_table, TIMESTAMP '{NOW}' AS _loaded_at, TIMESTAMP '{NOW}' AS _updated_at"
    return f"{out}, {at} AS _source_at" if at else out


def versions_sql(rows: str, key: str, tracked: tuple[str, ...], out: str, sk: str, source: str) -> str:
    """SCD2 over rows with columns of the dimension and ``seen``."""
    prev = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked)
    changed = " OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in tracked)
    return f"""
    WITH r AS ({rows}), s AS (SELECT *, {prev}, row_number() OVER w AS n FROM r WINDOW w AS (PARTITION BY {key} ORDER BY seen))
    SELECT sha256(strlen({key}::VARCHAR) || ':' || {key} || '@' || epoch_us(seen)) AS {sk}, {out}, seen AS valid_from,
           lead(seen) OVER (PARTITION BY {key} ORDER BY seen) AS valid_to,
           lead(seen) OVER (PARTITION BY {key} ORDER BY seen) IS NULL AS is_current, {audit_sql(source, None)}
    FROM s WHERE n = 1 OR {changed}"""


def at_const(df, *cols: str):
    return df.selectExpr(*cols, "timestamp'2024-01-01' AS ingested_at")


@query("dim_competition", f"""
SELECT CAST(r_regionkey AS varchar) AS competition_id, r_name AS competition_name, CAST(NULL AS varchar) AS short_name,
       'Rugby League' AS sport, {audit_sql("'entities_competition'")} FROM region""")
def dim_competition(spark, sf):
    df = at_const(table(spark, sf, "region"), "r_regionkey AS id", "r_name AS name")
    return build("dim_competition", {"entities_competition": df})


@query("dim_season", f"""
SELECT CAST(n_nationkey AS varchar) AS season_id, CAST(n_regionkey AS varchar) AS competition_id, n_name AS season_name,
       n_nationkey AS season_year, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 4 = 0 END AS active,
       CASE WHEN n_nationkey % 2 = 0 THEN true END AS current_season, {audit_sql("'entities_season'")} FROM nation""")
def dim_season(spark, sf):
    n = table(spark, sf, "nation")
    primary = at_const(n, "n_nationkey AS id", "n_regionkey AS competition_id", "n_name AS name")
    flags = at_const(n.filter("n_nationkey % 2 = 0"), "n_nationkey AS id", "n_nationkey % 4 = 0 AS active",
                     "'true' AS current_season")
    return build("dim_season", {"entities_season": primary, "season_list_season": flags})


@query("dim_round", f"""
SELECT CAST(p_partkey AS varchar) AS round_id, CAST(p_size AS varchar) AS season_id, CAST(NULL AS varchar) AS competition_id,
       CASE WHEN p_partkey % 4 = 0 THEN 'Semi Final' ELSE 'Round ' || p_size END AS round_name,
       CAST(NULL AS varchar) AS round_abbreviation, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS round_number,
       CASE WHEN p_partkey % 4 = 0 THEN 'Finals' ELSE 'Regular' END AS round_type, p_partkey % 4 = 0 AS is_finals,
       {audit_sql("'season_list_round'")} FROM part""")
def dim_round(spark, sf):
    df = at_const(table(spark, sf, "part"), "p_partkey AS id", "p_size AS season_id",
                  "CASE WHEN p_partkey % 4 = 0 THEN 'Semi Final' ELSE concat('Round ', p_size) END AS roundName")
    return build("dim_round", {"season_list_round": df})


@query("dim_venue", f"""
SELECT CAST(c_custkey AS varchar) AS venue_id, c_name AS venue_name, c_mktsegment AS city, CAST(NULL AS varchar) AS state,
       CAST(c_nationkey AS varchar) AS country, c_nationkey * 100 AS capacity, CAST(NULL AS varchar) AS surface_type,
       {audit_sql("'entities_venue'")} FROM customer""")
def dim_venue(spark, sf):
    df = at_const(table(spark, sf, "customer"), "c_custkey AS id", "c_name AS name", "c_mktsegment AS city",
                  "c_nationkey AS country", "c_nationkey * 100 AS capacity")
    return build("dim_venue", {"entities_venue": df})


@query("dim_position", f"""
SELECT CAST(p_partkey AS varchar) AS position_id, p_name AS position_name, p_brand AS position_abbreviation,
       p_type AS position_group, p_size AS jersey_number, {audit_sql("'entities_position'")} FROM part""")
def dim_position(spark, sf):
    df = at_const(table(spark, sf, "part"), "p_partkey AS id", "p_name AS name", "p_brand AS abbreviation",
                  "p_type AS position_group", "p_size AS jersey_number")
    return build("dim_position", {"entities_position": df})


@query("dim_scoring_method", f"""
SELECT CAST(o_custkey AS varchar) AS method_id, o_orderstatus AS method_name, CAST(o_orderkey % 5 AS int) AS points,
       {audit_sql("'entities_scoring_method'", "o_orderdate + to_microseconds(o_orderkey)")}
FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""")
def dim_scoring_method(spark, sf):
    # Several loads per method: one second per order keeps load times apart.
    df = table(spark, sf, "orders").selectExpr(
        "o_custkey AS id", "o_orderstatus AS name", "o_orderkey % 5 AS points",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    return build("dim_scoring_method", {"entities_scoring_method": df})


# Names and abbreviations change with each order; clubs bring a nickname in the middle of the time and another one later.
TEAM_EVENTS = """
  SELECT CAST(o_custkey AS varchar) AS team_id, o_orderstatus AS name, CAST(NULL AS varchar) AS nick, substr(o_orderpriority, 1, 1) AS abbr,
         CAST(NULL AS varchar) AS colour, o_orderdate + to_microseconds(o_orderkey) AS seen, 'entities_team' AS src FROM orders
  UNION ALL
  SELECT CAST(c_custkey AS varchar), NULL, c_mktsegment, NULL, CAST(c_nationkey AS varchar), TIMESTAMP '1995-06-01', 'season_list_club'
  FROM customer WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT CAST(c_custkey AS varchar), NULL, c_mktsegment || ' 2', NULL, NULL, TIMESTAMP '1997-06-01', 'season_list_club'
  FROM customer WHERE c_custkey % 4 = 0"""
TEAM_ROWS = f"""
  SELECT team_id, CAST(NULL AS varchar) AS competition_id, CAST(NULL AS varchar) AS season_id,
         last_value(name IGNORE NULLS) OVER w AS team_name, last_value(nick IGNORE NULLS) OVER w AS team_nickname,
         last_value(abbr IGNORE NULLS) OVER w AS team_abbreviation, last_value(colour IGNORE NULLS) OVER w AS team_colour_primary,
         CAST(NULL AS varchar) AS team_colour_secondary, seen, src
  FROM ({TEAM_EVENTS}) WINDOW w AS (PARTITION BY team_id ORDER BY seen)"""
TEAM_SQL = versions_sql(
    TEAM_ROWS, "team_id", ("team_name", "team_nickname", "team_abbreviation"),
    "team_id, competition_id, season_id, team_name, team_nickname, team_abbreviation, team_colour_primary, team_colour_secondary",
    "team_sk", "src")


def team_sources(spark, sf):
    teams = table(spark, sf, "orders").selectExpr(
        "o_custkey AS id", "o_orderstatus AS name", "substr(o_orderpriority, 1, 1) AS abbreviation",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    customers = table(spark, sf, "customer")
    clubs = customers.filter("c_custkey % 2 = 0").selectExpr(
        "c_custkey AS team_id", "c_mktsegment AS nickname", "c_nationkey AS colour_primary", "timestamp'1995-06-01' AS ingested_at")
    later = customers.filter("c_custkey % 4 = 0").selectExpr(
        "c_custkey AS team_id", "concat(c_mktsegment, ' 2') AS nickname", "cast(null as int) AS colour_primary", "timestamp'1997-06-01' AS ingested_at")
    return {"entities_team": teams, "season_list_club": clubs.unionByName(later)}


@query("dim_team", TEAM_SQL)
def dim_team(spark, sf):
    return build("dim_team", team_sources(spark, sf))


PLAYER_ROWS = """
  SELECT CAST(o_custkey AS varchar) AS player_id, o_orderstatus AS first_name, 'x' AS last_name, CAST(NULL AS date) AS date_of_birth,
         CAST(o_custkey % 30 AS int) AS height_cm, CAST(o_orderkey % 3 AS int) AS weight_kg, CAST(NULL AS varchar) AS nationality,
         substr(o_orderpriority, 1, 1) AS position_id, o_orderdate + to_microseconds(o_orderkey) AS seen,
         'player_profiles_player' AS src, o_orderstatus || ' x' AS display_name
  FROM orders WHERE o_custkey % 2 = 0
  UNION ALL
  SELECT CAST(c_custkey AS varchar), c_mktsegment, NULL, NULL, NULL, NULL, NULL, NULL, TIMESTAMP '2024-01-01',
         'entities_player', c_mktsegment FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 2 = 0)"""


PLAYER_SQL = versions_sql(
    PLAYER_ROWS, "player_id", ("position_id", "weight_kg", "height_cm"),
    "player_id, first_name, last_name, display_name, date_of_birth, height_cm, weight_kg, nationality, "
    "CAST(NULL AS varchar) AS country_of_birth, position_id, CAST(NULL AS int) AS career_debut_year, "
    "CAST(NULL AS int) AS career_appearances", "player_sk", "src")


def player_sources(spark, sf):
    profiles = table(spark, sf, "orders").filter("o_custkey % 2 = 0").selectExpr(
        "o_custkey AS player_id", "o_orderstatus AS player_first_name", "'x' AS player_last_name",
        "o_custkey % 30 AS height", "o_orderkey % 3 AS weight", "substr(o_orderpriority, 1, 1) AS position_id",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    entities = at_const(table(spark, sf, "customer"), "c_custkey AS id", "c_mktsegment AS first_name")
    return {"player_profiles_player": profiles, "entities_player": entities}


@query("dim_player", PLAYER_SQL)
def dim_player(spark, sf):
    return build("dim_player", player_sources(spark, sf))


COACH_ROWS = """
  SELECT CAST(o_custkey AS varchar) AS coach_id, CAST(year(o_orderdate) AS varchar) AS season_id,
         CAST(o_orderkey % 4 AS varchar) AS team_id, o_orderstatus AS coaching_role,
         o_orderdate + to_microseconds(o_orderkey) AS seen, 'season_list_coach' AS src FROM orders
  UNION ALL
  SELECT CAST(c_custkey AS varchar), '2023', 'squad', 'P', TIMESTAMP '2024-01-01', 'all_squads_coach' FROM customer"""


COACH_SQL = versions_sql(
    COACH_ROWS, "coach_id", ("team_id", "coaching_role"),
    "coach_id, season_id, team_id, CAST(NULL AS varchar) AS first_name, CAST(NULL AS varchar) AS last_name, "
    "CAST(NULL AS varchar) AS display_name, coaching_role", "coach_sk", "src")


def coach_sources(spark, sf):
    season = table(spark, sf, "orders").selectExpr(
        "o_custkey AS coachId", "year(o_orderdate) AS season_id", "o_orderkey % 4 AS teamId", "o_orderstatus AS role",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    squads = at_const(table(spark, sf, "customer"), "c_custkey AS coach_id", "'2023' AS season_id", "'squad' AS team_id",
                      "'P' AS role")
    return {"season_list_coach": season, "all_squads_coach": squads}


@query("dim_coach", COACH_SQL)
def dim_coach(spark, sf):
    return build("dim_coach", coach_sources(spark, sf))


@query("dim_official", f"""
SELECT CAST(o_custkey AS varchar) AS official_id, CAST(year(o_orderdate) AS varchar) AS season_id, o_orderstatus AS first_name,
       CAST(NULL AS varchar) AS last_name, o_orderstatus AS display_name, o_orderpriority AS role,
       {audit_sql("'season_list_official'", "o_orderdate + to_microseconds(o_orderkey)")}
FROM (SELECT * FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""")
def dim_official(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_custkey AS officialId", "year(o_orderdate) AS season_id", "o_orderstatus AS firstName", "o_orderpriority AS role",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    return build("dim_official", {"season_list_official": df})


@query("dim_reference_checks", """
SELECT 'dim_season:unique' AS check_id, 'PASS' AS status, 0::bigint AS bad_rows UNION ALL
SELECT 'dim_season:season_id', 'PASS', 0 UNION ALL
SELECT 'dim_season:competition_id', 'FAIL', count(*) FROM nation WHERE n_regionkey >= 3""")
def dim_reference_checks(spark, sf):
    competitions = at_const(table(spark, sf, "region").filter("r_regionkey < 3"), "r_regionkey AS id", "r_name AS name")
    built = {"dim_competition": build("dim_competition", {"entities_competition": competitions}),
             "dim_season": dim_season(spark, sf)}
    return dimension_checks(DIMENSIONS["dim_season"], built)


SPLIT = "timestamp'1996-01-01'"


def two_loads(name: str, sources: dict):
    """Built from the rows of an early window, then maintained with those of the next one."""
    early = {k: df.filter(f"ingested_at <= {SPLIT}") for k, df in sources.items()}
    late = {k: df.filter(f"ingested_at > {SPLIT}") for k, df in sources.items()}
    now = F.lit(NOW).cast("timestamp")
    stored = build_dimension(DIMENSIONS[name], early, now)
    return timed(build_dimension(DIMENSIONS[name], late, now, existing=stored))


@query("dim_team_two_loads", TEAM_SQL)
def dim_team_two_loads(spark, sf):
    return two_loads("dim_team", team_sources(spark, sf))


@query("dim_coach_two_loads", COACH_SQL)
def dim_coach_two_loads(spark, sf):
    return two_loads("dim_coach", coach_sources(spark, sf))


def late_load(name: str, sources: dict):
    """Built from the later rows first; the load of the early ones comes after them."""
    early = {k: df.filter(f"ingested_at <= {SPLIT}") for k, df in sources.items()}
    late = {k: df.filter(f"ingested_at > {SPLIT}") for k, df in sources.items()}
    now = F.lit(NOW).cast("timestamp")
    stored = build_dimension(DIMENSIONS[name], late, now)
    return timed(build_dimension(DIMENSIONS[name], early, now, existing=stored, history=sources))


@query("dim_team_late_load", TEAM_SQL)
def dim_team_late_load(spark, sf):
    return late_load("dim_team", team_sources(spark, sf))


@query("dim_coach_late_load", COACH_SQL)
def dim_coach_late_load(spark, sf):
    return late_load("dim_coach", coach_sources(spark, sf))


@query("dim_player_late_load", PLAYER_SQL)
def dim_player_late_load(spark, sf):
    return late_load("dim_player", player_sources(spark, sf))


@query("dim_official_two_loads", ORACLES["dim_official"])
def dim_official_two_loads(spark, sf):
    """The later load also brings the early rows again: late arrivals that must not win."""
    orders = table(spark, sf, "orders")
    rows = orders.selectExpr(
        "o_custkey AS officialId", "year(o_orderdate) AS season_id", "o_orderstatus AS firstName", "o_orderpriority AS role",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS ingested_at")
    now = F.lit(NOW).cast("timestamp")
    dim = DIMENSIONS["dim_official"]
    stored = build_dimension(dim, {"season_list_official": rows.filter("season_id % 2 = 0 OR role > '2'")}, now)
    late = rows.filter("season_id % 2 = 1 AND role <= '3' OR season_id % 2 = 0 AND role < '3'")
    return timed(build_dimension(dim, {"season_list_official": late}, now, existing=stored))


@query("dim_player_two_loads", PLAYER_SQL)
def dim_player_two_loads(spark, sf):
    return two_loads("dim_player", player_sources(spark, sf))


def unique_sql(name: str, sql: str, sk: str) -> str:
    return f"""SELECT '{name}:unique' AS check_id, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS bad_rows
    FROM (SELECT {sk} FROM ({sql}) GROUP BY 1 HAVING count(*) > 1)"""


@query("dim_key_checks", " UNION ALL ".join([
    unique_sql("dim_team", TEAM_SQL, "team_sk"), unique_sql("dim_player", PLAYER_SQL, "player_sk"), unique_sql("dim_coach", COACH_SQL, "coach_sk")]))
def dim_key_checks(spark, sf):
    """Surrogate keys are unique where versions are microseconds apart."""
    built = {"dim_team": dim_team(spark, sf), "dim_player": dim_player(spark, sf), "dim_coach": dim_coach(spark, sf)}
    found = [dimension_checks(DIMENSIONS[n], built).filter(F.col("check_id").endswith(":unique")) for n in built]
    return found[0].unionByName(found[1]).unionByName(found[2])


ALL_CHECKED = tuple(DIMENSIONS)


def checks_sql(name: str) -> str:
    """Keys and references of one dimension, counted over the SQL of it and of its parents."""
    dim, own = DIMENSIONS[name], ORACLES[name]
    keys = (dim.sk,) if dim.sk else dim.keys
    counts = [(f"{name}:unique", f"SELECT {', '.join(keys)} FROM ({own}) GROUP BY ALL HAVING count(*) > 1")]
    counts += [(f"{name}:{k}", f"SELECT 1 FROM ({own}) WHERE {k} IS NULL") for k in keys]
    counts += [(f"{name}:{c}" + (f":{parent}" if c in keys else ""), f"SELECT 1 FROM ({own}) WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM ({ORACLES[parent]}))")
               for c, (parent, k) in dim.references.items()]
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_id, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS bad_rows FROM ({rows})"
        for check, rows in counts)


@query("dim_all_checks", " UNION ALL ".join(map(checks_sql, ALL_CHECKED)))
def dim_all_checks(spark, sf):
    """Keys and references of all ten dimensions, each over whole tables."""
    built = {name: QUERIES[name](spark, sf) for name in ALL_CHECKED}
    return union_results([dimension_checks(DIMENSIONS[name], built) for name in ALL_CHECKED])
