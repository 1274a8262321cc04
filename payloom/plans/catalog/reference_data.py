"""Ladders, entity lists, squads, player profiles and associations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.functions.variant import get
from payloom.operators.keys import latest
from payloom.operators.reshape import unpivot_numbered
from payloom.plans.catalog.common import named, source, target
from payloom.plans.spec import AutoTree, Pipeline, Root


def _squad_rates() -> Root:
    return Root(
        table="competition", element=None, source="row",
        l0_fields=named(
            competition_id="competitionId", competition_name="competitionName", season_id="seasonId",
            competition_easy_kicking_success_rate="competitionEasyKickingSuccessRate",
            competition_tough_kicking_success_rate="competitionToughKickingSuccessRate",
        ),
    )


def recent_form(bronze: DataFrame) -> dict[str, DataFrame]:
    """Numbered ``recentFormN`` objects of a ladder position as rows, newest load per team and number."""
    rows = bronze.filter(F.col("l1element") == "ladderposition").select(
        get("l0payload", "teamId", as_type="string").alias("team_id"), "payload", "ingested_at", "ingested_from")
    form = unpivot_numbered(rows, "payload", "recentForm", value_path=("_text",), number="form_order", value="result")
    return {"ladderposition_recent_form": latest(form, ("team_id", "form_order"))}


def _ladder(name: str) -> Pipeline:
    return Pipeline(
        name=name, source=source(name), prefix=target(name),
        scope=name + "_{competition_id}_{season}", scope_exact=True,
        auto=(AutoTree("ladderposition", "ladderposition", keys={"ladderposition": ("team_id",)}),),
        extend=recent_form,
    )


# Section name of the entity feed -> (root alias, entity, its key columns).
ENTITY_SECTIONS = {
    "groundConditions": ("ground_condition", "groundCondition", ("id",)),
    "fantasyRules": ("fantasy_rule", "fantasyRule", ("id", "competition_id", "season_id")),
    "competitions": ("competitions_root", "competition", ("id",)),
    "players": ("player_entity", "player", ("id",)),
    "positions": ("positions_root", "position", ("id",)),
    "rounds": ("round_entity", "round", ("id", "competition_id", "season_id")),
    "scoringMethods": ("scoring_method", "scoringMethod", ("id",)),
    "seasons": ("season_entity", "season", ("id",)),
    "statistics": ("statistics_root", "statistic", ("id",)),
    "teams": ("team_entity", "team", ("id",)),
    "venues": ("venue_entity", "venue", ("id",)),
    "weatherConditions": ("weather_condition", "weatherCondition", ("id",)),
    "gameStates": ("game_state", "gameState", ("id",)),
    "officials": ("official_entity", "official", ("id",)),
}


def _entities() -> Pipeline:
    # Each section holds a list of one kind of entity; only the entities get a table.
    trees = tuple(
        AutoTree(section, root, force_list=frozenset({entity}), keys={entity: keys}, suppress=frozenset({root}))
        for section, (root, entity, keys) in ENTITY_SECTIONS.items()
    )
    return Pipeline(name="entities", source=source("entities"), prefix=target("entities"), auto=trees)


ALL_SQUADS = Pipeline(
    name="all_squads", source=source("all_squads"), prefix=target("all_squads"),
    scope="all_squads_{competition_id}_{season}", scope_exact=True,
    auto=(AutoTree(
        "competitions", "competitions", force_list=frozenset({"competition", "team", "player", "coach"}),
        flatten_structs={"teamHistory": "team_history_"},
        keys={"competitions": ("season_id", "ingested_from"), "competition": ("competition_id",),
              "team": ("team_id",), "player": ("player_id",), "coach": ("coach_id",)},
    ),),
)

PLAYER_PROFILE = Pipeline(
    name="player_profile", source=source("player_profiles"), prefix=target("player_profiles"),
    scope="player_profiles_{competition_id}_{season}",
    auto=(AutoTree("player", "player", force_list=frozenset({"team"}),
                   keys={"player": ("player_id",), "team": ("player_id", "team_id")}),),
)

PLAYER_ASSOCIATIONS = Pipeline(
    name="player_associations", source=source("player_associations"), prefix=target("player_associations"),
    auto=(AutoTree(
        "players", "players", exclude=frozenset({"positions"}), suppress=frozenset({"players"}),
        force_list=frozenset({"player", "competition", "season", "team"}),
        keys={"player": ("player_id",), "competition": ("player_id", "competition_id"),
              "season": ("player_id", "competition_id", "season_id"),
              "team": ("player_id", "competition_id", "season_id", "team_id")},
    ),),
)

SQUAD_LIST = Pipeline(
    name="squad_list", source=source("squad"), prefix=target("squad"), scope="squad_{competition_id}_{season}",
    auto=(AutoTree(
        "teams", "teams", force_list=frozenset({"team", "player", "coach"}),
        exclude=frozenset({"competitionEasyKickingSuccessRate", "competitionToughKickingSuccessRate"}),
        flatten_structs={"teamHistory": "team_history_"},
        keys={"team": ("team_id",), "player": ("player_id",), "coach": ("coach_id",)},
    ),),
    roots=(_squad_rates(),),
)


LADDER, LIVE_LADDER = _ladder("ladder"), _ladder("live_ladder")

PIPELINES = (LADDER, LIVE_LADDER, _entities(), ALL_SQUADS, PLAYER_PROFILE, PLAYER_ASSOCIATIONS, SQUAD_LIST)
