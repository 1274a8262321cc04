"""Registry of the domain pipelines: a name and its declarative spec."""

from payloom.plans.catalog import leaderboards, matches, players, reference_data, schedule, teams
from payloom.plans.spec import Pipeline

PIPELINES: dict[str, Pipeline] = {
    p.name: p
    for module in (reference_data, schedule, matches, players, teams, leaderboards)
    for p in module.PIPELINES
}


def pipeline(name: str) -> Pipeline:
    if name not in PIPELINES:
        raise KeyError(f"no pipeline {name!r}; known: {', '.join(sorted(PIPELINES))}")
    return PIPELINES[name]
