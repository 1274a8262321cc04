"""Headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Feeds are made from the test tables once, untimed, and stored as Parquet with
VARIANT columns. Timed per feed: inference of all shapes, then every output
table in full. Plain-table queries are timed as they are.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from payloom.operators.flatten import discover, flatten  # noqa: E402
from payloom.plans.catalog import pipeline  # noqa: E402
from payloom.plans.tables import pipeline_tables, plan_shapes  # noqa: E402
from payloom.suite import QUERIES, domain_leaderboards, domain_matches, domain_players, nested  # noqa: E402

PLAIN = ("latest_per_key", "first_per_key", "merge_rows", "distinct_rows", "scd2_versions", "scd2_surrogate_key",
         "dim_team", "dq_unique", "dq_orphans", "dq_unresolved_errors", "unpivot_numbered", "scalar_extraction",
         "run_list")
FEEDS = {
    "playerleaderboard": domain_leaderboards.leaderboard_bronze(
        "playerleaderboard", "leaderboardEntry", set(domain_leaderboards.PLAYER_ENTRY.values())),
    "playerstatsv2": domain_players.players_bronze("player_stats_v2"),
    "eventflow": domain_matches.event_flow_bronze,
    "livexy": domain_matches.xy_bronze,
}


def logged(folder: str) -> tuple[dict[str, int], dict[str, float]]:
    """Jobs and shuffled MB by job group, from an event log."""
    jobs: Counter = Counter()
    shuffled: dict[str, float] = defaultdict(float)
    group_of: dict[int, str] = {}
    for path in Path(folder).iterdir():
        for line in path.open(errors="replace"):
            if "SparkListenerJobStart" not in line and "SparkListenerTaskEnd" not in line:
                continue
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and (group := e.get("Properties", {}).get("spark.jobGroup.id")):
                jobs[group] += 1
                group_of.update(dict.fromkeys(e["Stage IDs"], group))
            elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in group_of:
                written = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                shuffled[group_of[e["Stage ID"]]] += written / 1e6
    return dict(jobs), {k: round(v, 1) for k, v in shuffled.items()}


def finish(df: DataFrame) -> None:
    """Compute every row; nothing is sent to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="payloom-bench-")
    os.mkdir(f"{scratch}/events")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("payloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{scratch}/events")
        .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(cpus).write.parquet(f"{scratch}/{name}.parquet")
    stored = {}
    for name, make in {"orders": nested.orders_unwrapped, **FEEDS}.items():
        make(spark, scratch).write.parquet(f"{scratch}/bronze/{name}")
        stored[name] = spark.read.parquet(f"{scratch}/bronze/{name}")

    times: dict[str, float] = {}

    def timed(name: str, work) -> object:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        return result

    for name in PLAIN:
        timed(name, lambda: finish(QUERIES[name](spark, sf)))
    plan = timed("flatten_discover", lambda: discover(stored["orders"], (nested.ORDER_TREE,), ""))
    for table, df in flatten(stored["orders"], nested.ORDER_TREE, plan=plan).items():
        timed(f"flatten_{table}", lambda: finish(df))
    for feed in FEEDS:
        pipe = pipeline(feed)
        shapes = timed(f"{feed}_shapes", lambda: plan_shapes(pipe, stored[feed]))
        if pipe.shared:
            # The shared hop is written when the tables are planned: its time counts, and planning with it.
            size = len(pipeline_tables(pipe, stored[feed], shapes))
            timed(f"{feed}_{size}_tables", lambda: [finish(df) for df in pipeline_tables(pipe, stored[feed], shapes, shared=feed).values()])
            continue
        tables = pipeline_tables(pipe, stored[feed], shapes, spread=pipe.spread)
        timed(f"{feed}_{len(tables)}_tables", lambda: [finish(df) for df in tables.values()])
    spark.stop()
    jobs, shuffled = logged(f"{scratch}/events")
    print(json.dumps({"metric": "total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")), "jobs": jobs, "shuffle_mb": shuffled}))


if __name__ == "__main__":
    main()
