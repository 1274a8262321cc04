"""Team statistics, coaches and the form guide."""

from __future__ import annotations

from payloom.plans.catalog.common import children, id_columns, named, part, source, target
from payloom.plans.spec import ALL, AutoTree, Node, Pipeline, Root

COMPETITION_NAME = named(competition_name="competitionName")
TEAM = named(team_id="teamId", team_name="teamName", is_home_team="isHomeTeam")
AVERAGES = "competitionTeamAverageStats"

# The statistics blocks of a team.
STAT_BLOCKS = ("currentRoundStats", "seasonStats", "seasonAverageStats", "historicalStats", "historicalAverageStats")

TEAM_STATS = Pipeline(
    name="teamstats", source=source("team_stats"), prefix=target("team_stats"),
    scope="team_stats_{competition_id}_{season}",
    id_parts=id_columns(2, "competition_id", "season_id", "round_number"),
    roots=(
        Root(table="teams", element=("teams", AVERAGES), source="row", l0_fields=COMPETITION_NAME,
             first_by=("competition_id", "season_id", "round_number")),
        Root(element="teams", unwrap=("team",), hand_down=named(
            team_id="teamId", team_name="teamName", team_logo_url="teamLogoURL", team_hex_colour="teamHexColour",
            team_hex_colour2="teamHexColour2"),
            children=(Node(table="team", named=tuple((b, (b,)) for b in STAT_BLOCKS), label="stat_type", fields=ALL,
                           require="filled"),)),
        Root(table="comp_avg", element=AVERAGES, fields=ALL, first_by=("competition_id", "season_id", "round_number")),
    ),
)

TEAM_STATS_V2 = Pipeline(
    name="teamstatsv2", source=source("team_stats_v2"), prefix=target("team_stats_v2"),
    scope="team_stats_v2_{competition_id}_{season}",
    id_parts=id_columns(3, "competition_id", "season_id"),
    roots=(
        Root(table="", element=("teams", AVERAGES), source="row", l0_fields=COMPETITION_NAME,
             first_by=("competition_id", "season_id")),
        Root(table="competition_average", element=AVERAGES, fields=ALL, first_by=("competition_id", "season_id")),
        Root(table="team", element="teams", unwrap=("team",), fields=named(team_id="teamId", team_name="teamName"),
             hand_down=named(team_id="teamId"), first_by=("competition_id", "team_id"), children=(
                 children("season_total", "seasonStats", children=(
                     children("round", "rounds", list_key="round"),)),
                 part("season_average", "seasonAverageStats"),
                 part("historical_total", "historicalStats"),
                 part("historical_average", "historicalAverageStats"),
             )),
    ),
)

COACHES = Pipeline(
    name="coaches", source=source("coaches"), prefix=target("coaches"), scope="coaches_{competition_id}_{season}",
    id_parts=id_columns(1, "competition_id", "season_id"),
    roots=(
        Root(table="", element="teams", source="row", l0_fields=COMPETITION_NAME,
             first_by=("competition_id", "season_id")),
        Root(element="teams", unwrap=("team",), hand_down=TEAM[:2],
             children=(children("coach", "coaches", list_key="coach"),)),
    ),
)

FORM_GUIDE = Pipeline(
    name="formguideformatch", source=source("form_guide_for_match"), prefix=target("form_guide"),
    scope="form_guide_for_match_{competition_id}_{season}",
    id_parts=id_columns(4, "competition_id", "season_id", last="game_id"),
    auto=(AutoTree(
        "teamFormGuideStats", "team_form_guide_stats", keys={"team_form_guide_stats": ("ingested_from",)},
        exclude=frozenset({
            "headToHead", "recentRecord", "recentGame", "seasonHomeAndAwayAverages", "home", "away",
            "seasonPlayerStats", "playerGame", "seasonTeamStats", "seasonWinLossBreakdown", "teamList",
            "playerLineup", "game"}),
        passthrough=("ingested_from", "ingested_at", "competition_id", "season_id", "game_id", "round_id"),
    ),),
    roots=(
        Root(table="", element=None, source="l0payload", fields=ALL, require="filled",
             first_by=("competition_id", "season_id", "game_id")),
        Root(table="last_ten_meeting", element="lastTenMeetings", unwrap=("game",), fields=ALL),
        Root(table="team", element="teamFormGuideStats", unwrap=("teamFormGuideStats",), fields=ALL, hand_down=TEAM,
             children=(
                 part("h2h", "headToHead"),
                 children("team_recent_game", "recentRecord", "recentGame"),
                 Node(table="season_home_away_averages", label="team_side", fields=ALL, named=tuple(
                     (side, ("seasonHomeAndAwayAverages", side)) for side in ("home", "away"))),
                 children("team_player_stats", "seasonPlayerStats", "playerGame"),
                 # Averages and maxima share column names; the maximum is the one that stays.
                 Node(table="player_game_stats", path=("seasonPlayerStats", "playerGame"),
                      fields=named(player_id="playerId", player_name="playerName"), require="any_scalar", inline=(
                          (("averageStats",), "", ALL), (("maxStats",), "", ALL), (("totalStats",), "total_", ALL))),
                 part("season_team_stats", "seasonTeamStats"),
                 part("season_win_loss_breakdown", "seasonWinLossBreakdown"),
                 children("player_line_up", "teamList", "playerLineup"),
             )),
    ),
)

PIPELINES = (TEAM_STATS, TEAM_STATS_V2, COACHES, FORM_GUIDE)
