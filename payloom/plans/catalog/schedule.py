"""Seasons, rounds and fixtures with their broadcast trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.functions.variant import get
from payloom.plans.catalog.common import source, target
from payloom.plans.spec import ALL, AutoTree, Field, Node, Pipeline, Root


def _season_part(table: str, wrapper: str, item: str) -> Node:
    return Node(table=table, path=(wrapper, item), fields=ALL)


SEASON_LIST = Pipeline(
    name="season_list", source=source("season_list"), prefix=target("season_list"),
    scope="season_list_{competition_id}", scope_exact=True, text=False, raw_names=True,
    auto=(AutoTree("seasons", "season", keys={"season": ("id",)},
                   exclude=frozenset({"rounds", "coaches", "clubs", "venues", "officials"})),),
    roots=(Root(element="seasons", hand_down=(Field("id", "season_id"),), children=(
        _season_part("round", "rounds", "round"),
        _season_part("club", "clubs", "club"),
        _season_part("coach", "coaches", "coach"),
        _season_part("venue", "venues", "venue"),
        _season_part("official", "officials", "official"),
    )),),
)


def fixtures(name: str, table: str, exclude: frozenset[str]) -> Pipeline:
    """Rounds, games, their teams and the region and broadcaster lists below them."""
    broadcaster = Node(table="gamefixture_region_broadcaster", path=("broadcasters", "broadcaster"), fields=ALL,
                       text_element="broadcaster")
    game = Node(table="gamefixture", path=("gameFixtures",), list_key="gameFixture", fields=ALL,
                hand_down=(Field("gameId", "game_id"),), children=(
                    Node(table="gamefixture_team", path=("teams", "team"), fields=ALL),
                    Node(table="gamefixture_region", path=("broadcastInfo", "regions", "region"), fields=ALL,
                         hand_down=(Field("regionid", "region_id"),), children=(broadcaster,)),
                ))
    bye = Node(table="teambye", path=("teamByes",), list_key="teamBye", fields=ALL)
    return Pipeline(
        name=name, source=source(table), prefix=target(table), scope=table + "_{competition_id}_{season}",
        text=False, raw_names=True,
        auto=(AutoTree("roundFixtures", "roundfixtures", keys={"roundfixtures": ("round_id",)},
                       exclude=frozenset({"gameFixtures", "teamByes"}) | exclude),),
        roots=(Root(element="roundFixtures", hand_down=(
            Field("roundId", "round_id"), Field("roundName", "round_name"),
            Field("roundAbbreviation", "round_abbreviation")), children=(game, bye)),),
    )


def broadcast_info():
    """The broadcast tree of a game: in the payload, in its first element, or in the l0 payload."""
    return F.coalesce(get("payload", "broadcastInfo"), get("payload", 0, "broadcastInfo"),
                      get("l0payload", "broadcastInfo"))


PIPELINES = (
    SEASON_LIST,
    fixtures("fixtures", "fixtures", frozenset({"_l1_array"})),
    fixtures("roundschedule", "round_fixtures", frozenset({"radioNetwork"})),
)
