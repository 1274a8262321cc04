"""Match data: statistics, events, snapshots, breakdowns and XY feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.functions.text import id_part
from payloom.functions.variant import get
from payloom.plans.catalog.common import children, id_columns, merge_into, named, part, source, target
from payloom.plans.catalog.schedule import broadcast_info
from payloom.plans.spec import ALL, AutoTree, Field, Node, Pipeline, Root

TEAM = named(team_id="teamId", team_name="teamName", is_home_team="isHomeTeam")
GAME_L0 = named(game_id="gameId", competition_id="competitionId", season_id="seasonId")


def game_key(*parts: int):
    """Key of a game within one feed, from the parts of its source id."""
    return {"__game": lambda: F.concat_ws("_", *[id_part("ingested_from", p) for p in parts])}


MATCH_DATA = Pipeline(
    name="matchdata", source=source("match_stats"), prefix=target("match_stats"),
    scope="match_stats_{competition_id}_{season}", raw_names=True,
    auto=(
        AutoTree("gameInfo", "gameinfo", keys={"gameinfo": ("ingested_from",)},
                 exclude=frozenset({"injuriesAndSuspensions", "radioNetwork", "broadcastInfo", "teamPlayer"})),
        AutoTree("teams", "teams", flatten_structs={"score": "score_"}, force_list=frozenset({"teamsMatch", "teamCoach", "insOuts"}),
                 exclude=frozenset({"injuriesAndSuspensions", "radioNetwork", "broadcastInfo", "teamPlayer"}),
                 keys={"teams": ("game_id", "ingested_from"), "teamsMatch": ("game_id", "team_id"),
                       "teamCoach": ("game_id", "team_id", "coach_id"), "insOuts": ("game_id", "team_id", "player_id")}),
    ),
    roots=(
        Root(element="gameInfo", source=broadcast_info, l0_fields=GAME_L0, children=(
            Node(path=("regions", "region"), hand_down=named(region_id="regionid", region_name="regionName"), children=(
                Node(table="broadcaster", path=("broadcasters", "broadcaster"),
                     fields=named(broadcaster_id="broadcasterID", broadcaster="broadcaster")),)),)),
        Root(element="teams", l0_fields=GAME_L0, children=(
            Node(path=("teamsMatch",), hand_down=named(team_id="teamId"), children=(
                Node(table="teams_team_player", path=("teamLineup", "teamPlayer"), fields=ALL,
                     inline=((("playerStats",), "player_stats_", ALL),)),)),)),
    ),
)


def _first_game_id():
    return F.coalesce(get("l0payload", "gameId", as_type="string"), get("payload", "gameId", as_type="string"),
                      get("payload", 0, "gameId", as_type="string"))


def _event_game_id():
    return F.coalesce(F.nullif(get("payload", "gameId", as_type="string"), F.lit("")), _first_game_id())


# Flow key -> path of its events below the event flow, table suffix.
POINT_FLOWS = {
    "possession_event": ("possessionFlow", "possessionEvent", "statPossessionEvent"),
    "penalty_event": ("penaltyFlow", "penaltyEvent", "statPenaltyEvent"),
    "error_event": ("errorFlow", "errorEvent", "statErrorEvent"),
    "scrum_event": ("scrumFlow", "scrumEvent", "statScrumEvent"),
}
ON_OFF = ((("on",), "on_", ALL), (("off",), "off_", ALL))


def _in_payload(column: str, name: str):
    return {column: lambda: F.coalesce(get("payload", name, as_type="string"),
                                       get("payload", 0, name, as_type="string"))}


MATCH_EVENTS = Pipeline(
    name="matchstatsandevents", source=source("match_stats_and_events"), prefix=target("match_stats_and_events"),
    scope="match_stats_and_events_{competition_id}_{season}", raw_names=True,
    auto=tuple(
        AutoTree(element, alias, keys={alias: ("game_id",)}, exclude=frozenset({
            "_l1_array", "radioNetwork", "injuriesAndSuspensions", "insAndOuts", "teamsMatch", "statScoringEvent",
            "statPossessionEvent", "statPenaltyEvent", "statErrorEvent", "statScrumEvent", "team", "interchanges",
            "events", "event"}))
        for element, alias in (("gameStats", "gamestats"), ("eventFlow", "eventflow"))
    ),
    roots=(
        Root(table="gamestats_gameinfo", element="gameStats", fields=ALL, context={"game_id": _first_game_id},
             children=(
                 Node(table="gamestats_team", path=("teams", "teamsMatch"), fields=ALL,
                      inline=((("score",), "score_", ALL), (("teamStats",), "team_stats_", ALL)),
                      hand_down=named(team_id="teamId"), children=(
                          Node(table="gamestats_team_player", path=("teamLineup", "teamPlayer"), fields=ALL,
                               inline=((("playerStats",), "player_stats_", ALL),)),)),)),
        Root(element="eventFlow", context={
            "game_id": _event_game_id, **_in_payload("competition_id", "competitionId"),
            **_in_payload("round_id", "roundId"), **_in_payload("season_id", "seasonId")}, children=(
                Node(table="eventflow_score_event_team", path=("scoreFlow", "scoreEvent", "teams", "team"), fields=ALL,
                     hand_down=TEAM[:1] + TEAM[2:], children=(
                         children("eventflow_score_event_team_statscoringevent", "statScoringEvent"),)),
                *[children(f"eventflow_{suffix}", *path) for suffix, path in POINT_FLOWS.items()],
                Node(path=("interchangeFlow", "team"), hand_down=TEAM[:1] + TEAM[2:], children=(
                    children("eventflow_interchange", "interchanges", inline=ON_OFF),)),
                Node(path=("disciplineFlow", "team"), hand_down=TEAM[:1] + TEAM[2:], children=(
                    children("eventflow_discipline", "events"),)),
                children("eventflow_commentary_event", "commentaryFlow", "event", require="any_scalar"),
                children("eventflow_colour_event", "colourEventsFlow", "event", require="any_scalar"),
            )),
    ),
)

# The fields of one XY event and the columns they become.
XY_FIELDS = {
    "si": "SI", "sn": "SN", "sv": "SV", "t": "T", "gm": "GM", "pi": "PI", "pn": "PN", "ex": "EX", "ey": "EY",
    "zo": "ZO", "as_stat": "AS", "gs": "GS", "hs": "HS", "vr": "VR", "tn": "TN", "sd": "SD", "utc": "UTC",
}

LIVE_XY = Pipeline(
    name="livexy", source=source("live_xy"), prefix=target("live_xy"), scope="live_xy_{competition_id}_{season}",
    text=False, spread=True,
    auto=(AutoTree("teams", "teams", exclude=frozenset({"xandYFeed1stHalf", "xandYFeed2ndHalf", "stat"}),
                   keys={"teams": ("game_id", "ingested_from"), "team": ("game_id", "team_id")}),),
    roots=(Root(element="teams", unwrap=("team",), hand_down=TEAM, children=(
        # Events are told apart by their whole row: one statistic occurs many times in a half.
        Node(table="teams_stat", label="feed_period", named=(
            ("1", ("xandYFeed1stHalf", "stat")), ("2", ("xandYFeed2ndHalf", "stat"))),
            fields=named(**XY_FIELDS),
            derive={"feed_period": lambda: F.col("feed_period").cast("int")},
            where=lambda: F.col("si").isNotNull(), distinct=True),)),),
)


def _flow(table: str, element: str, *unwrap: str) -> Root:
    return Root(table=table, element=element, unwrap=unwrap, fields=ALL)


EVENT_FLOW = Pipeline(
    name="eventflow", source=source("match_events_flow"), prefix=target("event_flow"),
    scope="match_events_flow_{competition_id}_{season}",
    id_parts=id_columns(3, "competition_id", "season_id", last="game_id"),
    roots=(
        Root(table="__l0", element=None, source="l0payload", fields=ALL, require="filled", own_wins=True,
             derive=game_key(3, 4, -1)),
        Root(table="score_team", element="scoreFlow", unwrap=("scoreEvent", "teams", "team"), fields=ALL,
             hand_down=TEAM, children=(children("score_event", "statScoringEvent"),)),
        _flow("possession", "possessionFlow", "possessionEvent", "statPossessionEvent"),
        _flow("penalty", "penaltyFlow", "penaltyEvent", "statPenaltyEvent"),
        _flow("error", "errorFlow", "errorEvent", "statErrorEvent"),
        _flow("scrum", "scrumFlow", "scrumEvent", "statScrumEvent"),
        Root(element="interchangeFlow", unwrap=("team",), hand_down=TEAM,
             children=(children("interchange", "interchanges", inline=ON_OFF),)),
        _flow("commentary", "commentaryFlow", "event"),
        _flow("colour", "colourEventsFlow", "event"),
        Root(element="disciplineFlow", unwrap=("team",), hand_down=TEAM,
             children=(children("discipline", "events"),)),
    ),
    post=merge_into("", ("__l0",), ("__game",)),
)

POSITION_ABBREV = (Field("positionAbbrev", "position_abbrev", "string", "text_node"),)

MATCH_SNAPSHOT = Pipeline(
    name="matchsnapshotdata", source=source("match_snapshot"), prefix=target("match_snapshot"),
    scope="match_snapshot_{competition_id}_{season}",
    id_parts=id_columns(2, "competition_id", "season_id", last="game_id"),
    roots=(
        Root(table="__l0", element=None, source="l0payload", fields=ALL, require="filled", own_wins=True,
             derive=game_key(2, 3, -1)),
        Root(table="__info", element="gameInfo", fields=ALL, require="filled", own_wins=True,
             derive=game_key(2, 3, -1)),
        Root(table="team", element="teams", unwrap=("teamsMatch",), fields=ALL, hand_down=TEAM,
             inline=((("score",), "score_", ALL), (("teamLineup",), "", ALL), (("teamStats",), "team_stats_", ALL)),
             children=(Node(table="team_player", path=("teamLineup", "teamPlayer"), fields=ALL,
                            inline=((("playerStats",), "player_stats_", ALL),), extra=POSITION_ABBREV),)),
        Root(element="interchangeFlow", unwrap=("team",), hand_down=TEAM,
             children=(children("interchange", "interchanges", inline=ON_OFF),)),
        _flow("injuries_suspensions", "injuriesAndSuspensions"),
        Root(element="disciplineFlow", unwrap=("team",), hand_down=TEAM,
             children=(children("discipline", "events"),)),
    ),
    post=merge_into("", ("__l0", "__info"), ("__game",)),
)

ROUND_BREAKDOWN = Pipeline(
    name="matchdatabyroundbreakdown", source=source("match_data_by_round_breakdown"), prefix=target("round_match_data"),
    scope="match_data_by_round_breakdown_{competition_id}_{season}",
    id_parts=id_columns(5, "competition_id", "season_id", "round_id", "game_num", "game_id"),
    roots=(
        Root(table="", element=("teams", "gameInfo"), source="row", l0_fields=named(
            competition_name="competitionName", game_state="gameState", game_state_id="gameStateId",
            round_name="roundName"), first_by=("competition_id", "season_id", "round_id", "game_id")),
        Root(table="game_info", element="gameInfo", fields=ALL,
             first_by=("competition_id", "season_id", "round_id", "game_id")),
        Root(table="team", element="teams", unwrap=("teamsMatch",), fields=ALL, hand_down=TEAM[:1], children=(
            part("team_score", "score"),
            Node(path=("teamLineup",), hand_down=named(lineup_status_id="teamLineUpStatusID",
                                                      lineup_status="teamLineUpStatus"),
                 children=(Node(table="team_lineup", path=("teamPlayer",), fields=ALL,
                                hand_down=named(player_id="playerId")),)),
            Node(path=("teamLineup", "teamPlayer"), hand_down=named(player_id="playerId"), children=(
                part("player_stats", "playerStats", "matchStats"),
                children("player_period_stats", "playerStats", "periodStats"),)),
            part("team_stats", "teamStats", "matchStats"),
            children("team_period_stats", "teamStats", "periodStats"),
            children("team_coach", "teamCoaches", "teamCoach"),
        )),
    ),
)

PIPELINES = (MATCH_DATA, MATCH_EVENTS, LIVE_XY, EVENT_FLOW, MATCH_SNAPSHOT, ROUND_BREAKDOWN)
