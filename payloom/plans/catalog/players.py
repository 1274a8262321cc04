"""Player statistics trees: player, career, season, team and round."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from payloom.functions.variant import present
from payloom.plans.catalog.common import children, id_columns, named, part, source, target
from payloom.plans.spec import ALL, Node, Pipeline, Root


def l0_or_nothing() -> Column:
    """The l0 payload, or an empty object for rows without one."""
    return F.coalesce(F.when(present("l0payload"), F.col("l0payload")), F.parse_json(F.lit("{}")))


def player_stats(name: str, table: str, prefix: str, start: int, average: str, team_columns: Mapping[str, Mapping],
                 has_competition_average: bool) -> Pipeline:
    """Root, player and eight or nine statistics tables of a player feed.

    ``average`` is the suffix of per-team averages, ``team_columns`` names the
    columns that identify a team below the career and below a season.
    """
    def teams(scope: str) -> Node:
        return Node(path=("teams",), list_key="team", hand_down=named(**team_columns[scope]), children=(
            part(f"{scope}_team_total", "teamStatsTotal"),
            part(f"{scope}_team_{average}", "teamStatsAverage"),
        ))

    # A season's own id wins; the id in the source key is the fallback.
    def season_id():
        return {"season_id": lambda: F.coalesce(F.nullif(F.col("__season_id"), F.lit("")), F.col("season_id"))}

    def in_season(node: Node) -> Node:
        return dataclasses.replace(node, derive=season_id() if node.table else {},
                                   children=tuple(in_season(c) for c in node.children))

    season = Node(path=("season",), hand_down=named(__season_id="seasonId"), children=tuple(in_season(n) for n in (
        part("season_total", "seasonStatsTotal", children=(
            children("round", "roundStats", list_key="round"),)),
        part("season_average", "seasonStatsAverage"),
        teams("season"),
    )))
    career = Node(path=("career",), children=(
        part("career_total", "careerStatsTotal"),
        part("career_average", "careerStatsAverage"),
        teams("career"),
    ))
    player = named(player_id="playerId")
    elements = ("players", "competitionPlayerAverageStats") if has_competition_average else "players"
    root_key = ("competition_id", "season_id")
    roots = [
        Root(table="player", element="players", unwrap=("player",), fields=ALL, hand_down=player,
             children=(career, season)),
    ]
    if has_competition_average:
        roots.insert(0, Root(table="", element=elements, source="row", first_by=root_key,
                             l0_fields=named(competition_name="competitionName")))
        roots.append(Root(table="competition_average", element="competitionPlayerAverageStats", fields=ALL,
                          first_by=root_key))
    else:
        roots.insert(0, Root(table="", element=elements, source=l0_or_nothing, fields=ALL, first_by=root_key))
    return Pipeline(
        name=name, source=source(table), prefix=target(prefix), scope=table + "_{competition_id}_{season}",
        id_parts=id_columns(start, "competition_id", "season_id"), roots=tuple(roots), shared=True,
    )


def _team(prefix: str) -> dict[str, str]:
    return {f"{prefix}team_id": "teamId", f"{prefix}team_name": "teamName", "is_current_team": "isCurrentTeam"}


PIPELINES = (
    player_stats("playerstatsv2", "player_stats_v2", "player_stats_v2", 3, "average",
                 {"career": _team("career_"), "season": _team("season_")}, True),
    player_stats("playerstatsmaster", "historical_stats_by_round", "player_stats_master", 4, "avg",
                 {"career": _team(""), "season": _team("")}, False),
)
