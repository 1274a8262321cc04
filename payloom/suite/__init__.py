"""Queries over the test tables: every operator, with the SQL that gives the same rows.

Nested rows are made from single table rows, without grouping, so building
them scales like a scan and no payload depends on how often a key occurs.
"""

from payloom.suite import (
    checks, dimensions, domain_leaderboards, domain_matches, domain_players, domain_reference, logs, nested, tables,
)
from payloom.suite.base import ORACLES, QUERIES
