"""The leaderboard and milestone family: statistic, then ranked entries."""

from __future__ import annotations

from collections.abc import Mapping

from payloom.plans.catalog.common import id_columns, named, source, target
from payloom.plans.spec import Node, Pipeline, Root

# Entry columns and the payload fields they come from.
TEAM = {"team_id": "TeamID", "team_name": "TeamName", "team_abbrev": "TeamAbbrev"}
RANKED = {"rank": "Rank", "value": "Value", "appearances": "Appearances"}
OPPONENT = {"opponent_id": "OpponentId", "opponent_name": "OpponentName"}
PLAYER = {"player_id": "PlayerID", "player_name": "PlayerName"}
POSITION = {"position_id": "PositionID", "position_name": "PositionName"}
CAREER_BEST = {"match_season_id": "SeasonId", "round_id": "RoundId"}
MILESTONE = {"value": "Value", "required_amount": "RequiredAmount", "achieved": "Achieved"}
TOP_THREE = {"game_id": "GameID", "rank": "Rank", "season_id": "SeasonId", "value": "Value"}

STAT = named(stat_id="ID", stat_name="statName")
COMPETITION_NAME = named(competition_name="competitionName")


def leaderboard(name: str, table: str, prefix: str, start: int, entry: Mapping[str, str],
                suffixes: tuple[str, str, str], ids: tuple[str, ...] = ("competition_id", "season_id", "round_number"),
                constants: Mapping[str, str] | None = None, entry_key: str = "leaderboardEntry",
                stat_name_on_entry: bool = True, root_has_name: bool = True,
                root_key_has_name: bool = True) -> Pipeline:
    """Root, statistic and entry tables of one leaderboard feed."""
    root, stat, entries = suffixes
    constants = dict(constants or {})
    key = (*ids, *[c for c in constants if c not in ids])
    if root_has_name and root_key_has_name:
        key = (*key, "competition_name")
    season = "_{season}" if "season_id" in ids else ""
    return Pipeline(
        name=name, source=source(table), prefix=target(prefix), scope=table + "_{competition_id}" + season,
        id_parts=id_columns(start, *ids), constants=constants,
        roots=(
            Root(table=root, element="stats", source="row", first_by=key,
                 l0_fields=COMPETITION_NAME if root_has_name else ()),
            Root(table=stat, element="stats", unwrap=("leaderboardStat",), fields=STAT,
                 hand_down=STAT if stat_name_on_entry else STAT[:1],
                 children=(Node(table=entries, path=(entry_key,), fields=named(**entry)),)),
        ),
    )


ALL_TIME = {"season_id": "0", "round_number": "0"}
SHORT = ("leaderboard", "stat", "entry")
LONG = ("", "leaderboard_stat", "leaderboard_entry")

TOP_THREE_REPORT = Pipeline(
    name="competitionteamtopthreeleaderboardreport", source=source("top_three_leaderboard"),
    prefix=target("top_three_lb"), scope="top_three_leaderboard_{competition_id}",
    id_parts=id_columns(3, "competition_id"),
    roots=(
        Root(table="leaderboard", element="teams", source="row", first_by=("competition_id", "competition_name"),
             l0_fields=COMPETITION_NAME),
        Root(table="team", element="teams", unwrap=("team",),
             fields=named(team_id="TeamID", team_name="TeamName", team_abbrev="TeamAbbreviation"),
             hand_down=named(team_id="TeamID", team_name="TeamName"),
             children=(Node(table="stat", path=("stats", "stat"), fields=STAT, hand_down=STAT, children=(
                 Node(table="entry", path=("statEntry",), fields=named(**TOP_THREE)),)),)),
    ),
)

MATCH_MILESTONES = Pipeline(
    name="matchmilestones", source=source("upcoming_match_milestones"), prefix=target("upcoming_match_milestones"),
    scope="upcoming_match_milestones_{competition_id}_{season}",
    id_parts=id_columns(3, "competition_id", "season_id", last="game_id"),
    roots=(
        Root(table="", element=None, source="l0payload", fields="*", require="filled",
             first_by=("competition_id", "season_id", "game_id")),
        Root(table=None, element="teams", unwrap=("team",), hand_down=named(team_id="TeamID", team_name="TeamName"),
             children=(
                 Node(path=("teamStats", "stats", "leaderboardStat"), hand_down=STAT, children=(
                     Node(table="team", path=("milestoneEntry",), fields=named(**MILESTONE)),)),
                 Node(table="player_stat", path=("playerStats", "stats", "leaderboardStat"), fields=STAT,
                      hand_down=STAT, first_by=("competition_id", "season_id", "game_id", "team_id", "stat_id"),
                      children=(Node(table="player_stat_entry", path=("milestoneEntry",),
                                     fields=named(**PLAYER, **MILESTONE)),)),
             )),
    ),
)

PIPELINES = (
    leaderboard("playerleaderboard", "player_leaderboards", "player_lb", 2,
                {**TEAM, **PLAYER, **POSITION, **RANKED}, SHORT, stat_name_on_entry=False, root_key_has_name=False),
    leaderboard("playerleaderboardsaverage", "player_leaderboards_average", "player_lb_avg", 3,
                {**TEAM, **PLAYER, **POSITION, **RANKED}, SHORT, stat_name_on_entry=False, root_key_has_name=False),
    leaderboard("teamleaderboards", "team_leaderboards", "team_leaderboards", 2, {**TEAM, **RANKED}, LONG),
    leaderboard("teamleaderboardsaverage", "team_leaderboards_average", "team_leaderboards_average", 3,
                {**TEAM, **RANKED}, LONG),
    leaderboard("teamleaderboardsperformance", "team_leaderboards_performance", "team_leaderboards_performance", 3,
                {**TEAM, **OPPONENT, **RANKED}, LONG),
    leaderboard("teamleaderboard", "team_history_leaderboard", "comp_team_history_leaderboard", 3,
                {**TEAM, **RANKED}, ("", "stat", "entry"), ids=("competition_id",), constants=ALL_TIME),
    leaderboard("competitionteamcareerbestleaderboardreport", "career_best_leaderboard", "career_best_lb", 3,
                {**TEAM, **RANKED, **CAREER_BEST, **OPPONENT}, SHORT, ids=("competition_id",), constants=ALL_TIME),
    leaderboard("playermilestones", "player_milestones", "player_milestones", 2,
                {**PLAYER, "team_id": "TeamID", "team_name": "TeamName", **MILESTONE},
                ("", "leaderboard_stat", "milestone_entry"), ids=("competition_id", "season_id"),
                entry_key="milestoneEntry", root_has_name=False),
    TOP_THREE_REPORT,
    MATCH_MILESTONES,
)
