"""The quality plan of each pipeline: keys of its tables, rules between them, state of its source and logs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from payloom.operators import quality as Q

Checks = dict[str, Callable[[], DataFrame] | Q.Together]

# Key columns of output tables, by pipeline and table.
KEYS: dict[str, dict[str, tuple[str, ...]]] = {
    "ladder": {"ladderposition": ("competition_id", "season_id", "team_id")},
    "live_ladder": {"ladderposition": ("competition_id", "season_id", "team_id")},
    "player_profile": {"player": ("player_id",), "team": ("player_id", "team_id")},
    "player_associations": {
        "player": ("player_id",), "competition": ("player_id", "competition_id"), "season": ("player_id", "competition_id", "season_id"),
        "team": ("player_id", "competition_id", "season_id", "team_id")},
    "matchdata": {
        "gameinfo": ("game_id",), "teams": ("game_id", "ingested_from"), "teams_match": ("game_id", "team_id"),
        "team_coach": ("game_id", "team_id", "coach_id"), "ins_outs": ("game_id", "team_id", "player_id")},
    "matchstatsandevents": {"gamestats": ("game_id", "ingested_from"), "eventflow": ("game_id", "ingested_from")},
    "livexy": {"teams": ("game_id", "ingested_from"), "team": ("game_id", "team_id")},
    "all_squads": {
        "competitions": ("season_id", "ingested_from"), "competition": ("competition_id",), "team": ("team_id",), "player": ("player_id",),
        "coach": ("coach_id",)},
    "squad_list": {"team": ("team_id",), "player": ("player_id",), "coach": ("coach_id",)},
    "entities": {t: ("id",) for t in ("competition", "team", "player", "venue", "position", "statistic")},
}
# Tables with exactly so many rows per key; parents that need a child; children that need a parent.
EXACTLY = {"matchdata": (("teams_match", ("game_id",), 2),), "livexy": (("team", ("game_id",), 2),)}
HAS_CHILD = {
    "player_profile": (("player", "team", ("player_id",)),),
    "all_squads": (("competition", "team", ("competition_id",)), ("team", "player", ("team_id",))),
    "squad_list": (("team", "player", ("team_id",)),),
}
HAS_PARENT = {"matchdata": (("teams_match", "gameinfo", ("game_id",)),)}


def table_checks(pipeline: str, tables: Mapping[str, DataFrame]) -> Checks:
    """Checks of a pipeline's output tables: one query for each table, or for all tables with rules between them. A table that is missing makes its checks ERROR rows."""
    exactly = EXACTLY.get(pipeline, ())
    rules = {table: Q.TableRules(keys, keys, tuple((k, n) for t, k, n in exactly if t == table)) for table, keys in KEYS.get(pipeline, {}).items()}
    alone = {t: Q.table_rules(lambda t=t: tables[t], f"{pipeline}.{t}", r) for t, r in rules.items()}
    matches = [(f"{pipeline}.{parent}:has {child}", parent, child, on) for parent, child, on in HAS_CHILD.get(pipeline, ())]
    matches += [(f"{pipeline}.{child}:in {parent}", child, parent, on) for child, parent, on in HAS_PARENT.get(pipeline, ())]

    groups = [{t} for t in rules]
    for _, left, right, _ in matches:
        joined = [g for g in groups if g & {left, right}]
        groups = [*(g for g in groups if g not in joined), {left, right}.union(*joined)]
    checks: Checks = {}
    # Groups of several tables take longest.
    for group in sorted(groups, key=len, reverse=True):
        within = [m for m in matches if m[1] in group]
        apart: Checks = {f"{pipeline}.{t}": alone[t] for t in rules if t in group}
        apart |= {i: lambda i=i, a=left, b=right, on=on: Q.expect_parent(tables[a], tables[b], on, i) for i, left, right, on in within}
        if not within:
            checks |= apart
            continue

        def together(group=group, within=within) -> DataFrame:
            read = {f"{pipeline}.{t}": (tables[t], r) for t, r in rules.items() if t in group}
            return Q.check_related(read, [Q.Match(i, tables[left], tables[right], on) for i, left, right, on in within])

        checks[" ".join(apart)] = Q.Together(together, apart)
    return checks


def source_checks(pipeline: str, bronze: Callable[[], DataFrame], scope: Column | None = None) -> Checks:
    """The source can be read, has rows (in scope), and every row has a load time."""
    name = f"{pipeline}.source"
    return {name: Q.table_rules(bronze, name, Q.TableRules(not_null=("ingested_at",), where=scope))}


def log_checks(expected: DataFrame, audit: DataFrame, errors: DataFrame, hours: int = 48) -> Checks:
    """Runs of all expected keys (column config_name) are noted, advance, are recent, and no error is left open."""
    return {
        "log:expected": lambda: Q.expect_keys(expected, audit, "log:expected"),
        "log": Q.table_rules(lambda: audit, "log", Q.TableRules(("config_name", "ingested_at"), ("ingested_at",), rows=False)),
        "log:advancing": lambda: Q.expect_advancing(audit, "log:advancing"),
        "log:fresh": lambda: Q.expect_fresh(audit, "log:fresh", "flattened_at", hours),
        "log:resolved": lambda: Q.expect_resolved(errors, audit, "log:resolved"),
    }


def check_pipelines(spark: SparkSession, outputs: Mapping[str, Mapping[str, DataFrame]],
                    sources: Mapping[str, Callable[[], DataFrame]] | None = None, more: Iterable[Checks] = ()) -> DataFrame:
    """Results of the quality plans of the given pipelines and sources, one scan per table and source."""
    checks: Checks = {}
    for pipeline, tables in outputs.items():
        checks |= table_checks(pipeline, tables)
    for pipeline, bronze in (sources or {}).items():
        checks |= source_checks(pipeline, bronze)
    for part in more:
        checks |= part
    return Q.run_checks(spark, checks)
