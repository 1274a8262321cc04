"""Incremental loads: high-water marks, the run list and the runner."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.operators.keys import max_per_key
from payloom.plans import ledger as ledgers
from payloom.plans.spec import Pipeline
from payloom.plans.tables import pipeline_tables, plan_shapes, table_name
from payloom.sinks import logs
from payloom.sinks.tables import write_all
from payloom.sources.bronze import read_bronze, scope_filter, scope_params, stage, window_filter

LOG = logging.getLogger(__name__)
RUN_COLUMNS = ("config_name", "competition_id", "season", "audit_key", "src_watermark", "tgt_watermark")


def param_grid(spark: SparkSession, competitions: str = "", seasons: str = "") -> DataFrame:
    """All combinations of two comma lists; an empty list stands for one empty value."""
    def items(text: str):
        parts = F.transform(F.split(F.lit(text), ","), lambda x: F.trim(x))
        return F.explode(F.filter(parts, lambda x: x != "") if text.strip(" ,") else F.array(F.lit("")))

    return spark.range(1).select(items(competitions).alias("competition_id")).select(
        "competition_id", items(seasons).alias("season"))


def combinations(pipe: Pipeline, competitions: Sequence[str], seasons: Sequence[str]) -> list[dict[str, str]]:
    """Parameter sets a pipeline needs; empty if a needed list was not given."""
    needed = scope_params(pipe.scope)
    if not needed:
        return [{}]
    if "season" not in needed:
        return [{"competition_id": c} for c in competitions]
    return [{"competition_id": c, "season": s} for c in competitions for s in seasons]


def key_of(name: str, params: Mapping[str, str]) -> str:
    """Composite audit key of one run, the same in every mode."""
    return "_".join([name, *[params[p] for p in ("competition_id", "season") if params.get(p)]])


def source_watermarks(bronze: DataFrame, pipe: Pipeline, params: Sequence[Mapping[str, str]]) -> DataFrame:
    """Newest load per parameter set of one source, all sets in one scan."""
    marks = []
    for p in params:
        cond = scope_filter(pipe.scope, p, pipe.scope_exact)
        value = F.col("ingested_at") if cond is None else F.when(cond, F.col("ingested_at"))
        marks.append((p, F.max(value)))
    # One output row, whose struct array turns into one row per parameter set.
    row = bronze.agg(*[m.alias(f"m{i}") for i, (_, m) in enumerate(marks)])
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(pipe.name).alias("config_name"), F.lit(p.get("competition_id", "")).alias("competition_id"),
            F.lit(p.get("season", "")).alias("season"), F.lit(key_of(pipe.name, p)).alias("audit_key"),
            F.col(f"m{i}").cast("timestamp").alias("src_watermark"))
        for i, (p, _) in enumerate(marks)])))


def target_watermarks(audit: DataFrame) -> DataFrame:
    """Newest processed load and number of runs per audit key."""
    return max_per_key(audit, ["config_name"], "ingested_at", "tgt_watermark", "runs").withColumnRenamed(
        "config_name", "audit_key")


def run_list(sources: DataFrame, audit: DataFrame) -> DataFrame:
    """Entries with data newer than their last run, or without a run yet. One plan for all keys."""
    joined = sources.join(target_watermarks(audit), "audit_key", "left")
    due = F.col("src_watermark").isNotNull() & (
        F.col("tgt_watermark").isNull() | (F.col("src_watermark") > F.col("tgt_watermark")))
    return joined.filter(due).drop("runs")


@dataclass(frozen=True)
class Run:
    """One entry of the run list, as the runner takes it."""

    pipeline: Pipeline
    params: Mapping[str, str]
    low: datetime | None = None
    high: datetime | None = None
    # With a ledger the run takes the loads that it lacks, in place of a window; ``runs`` are those its key has had.
    ledger: str | None = None
    runs: int = 0

    @property
    def key(self) -> str:
        return key_of(self.pipeline.name, self.params)


def discover_runs(spark: SparkSession, pipelines: Iterable[Pipeline], audit: str, competitions: Sequence[str] = (),
                  seasons: Sequence[str] = (), sources: Mapping[str, str] | None = None,
                  errors: str | None = None, run_id: str | None = None, ledger: str | None = None) -> list[Run]:
    """What is due now. A source that cannot be read stops discovery, after all were looked at.

    With a ``ledger`` (a table of ``plans.ledger``) every load counts that it lacks, also one with a load time
    below the high-water mark. A load, i.e. a source id and a load time, has to be in the source as a whole.
    """
    run_id = run_id or str(uuid.uuid4())
    frames, failed = [], {}
    by_name = {}
    for pipe in pipelines:
        params = combinations(pipe, competitions, seasons)
        if not params:
            continue
        by_name[pipe.name] = pipe
        try:
            bronze = read_bronze(spark, (sources or {}).get(pipe.name, pipe.source))
            frames.append(source_watermarks(bronze, pipe, params))
        except Exception as e:  # logged, and raised together below
            failed[pipe.name] = e
            if errors:
                logs.log_error(spark, errors, run_id, pipe.name, e)
    if failed:
        raise RuntimeError(f"sources of {', '.join(sorted(failed))} cannot be read: "
                           + "; ".join(f"{k}: {v}" for k, v in failed.items()))
    if not frames:
        return []
    marks = frames[0]
    for f in frames[1:]:
        marks = marks.unionAll(f)
    if ledger:
        return _due_by_ledger(spark, by_name, audit, competitions, seasons, sources, ledger)
    # One row per pipeline and parameter set: bounded by the request, not by the data.
    rows = run_list(marks, spark.table(audit)).collect()
    return [
        Run(by_name[r["config_name"]],
            {k: r[k] for k in ("competition_id", "season") if r[k]}, r["tgt_watermark"], r["src_watermark"])
        for r in sorted(rows, key=lambda r: r["audit_key"])
    ]


def _due_by_ledger(spark: SparkSession, by_name: Mapping[str, Pipeline], audit: str, competitions: Sequence[str], seasons: Sequence[str],
                   sources: Mapping[str, str] | None, ledger: str) -> list[Run]:
    ledgers.create_ledger(spark, ledger)
    runs = {r["audit_key"]: r["runs"] for r in target_watermarks(spark.table(audit)).collect()}
    out = []
    for name, pipe in sorted(by_name.items()):
        for p in combinations(pipe, competitions, seasons):
            bronze = read_bronze(spark, (sources or {}).get(name, pipe.source), scope_filter(pipe.scope, p, pipe.scope_exact))
            entry = Run(pipe, p, ledger=ledger, runs=runs.get(key_of(name, p), 0))
            if not ledgers.new_loads(bronze, spark.table(ledger), entry.key).isEmpty():
                out.append(entry)
    return out


def run(spark: SparkSession, entry: Run, audit: str, run_id: str, source: str | None = None,
        mode: str | None = None, shapes=None, staged: bool = False) -> dict[str, int]:
    """Flatten one window of one source into its tables and note it in the audit log.

    All tables get the rows of this load under one load key, the run's key and
    the start of its window. The audit row is written last: a run that failed
    in between is due again from the same start, also where more rows have
    arrived since, and replaces what it had written. A run from the start takes
    the place of all windows that its key has had. ``staged`` copies the
    window's rows aside first, for sources that are not partitioned well enough
    to be read once per table.
    """
    pipe = entry.pipeline
    source = source or pipe.source
    bronze = read_bronze(spark, source, scope_filter(pipe.scope, entry.params, pipe.scope_exact),
                         window_filter(entry.low, entry.high))
    loads = ledgers.due(bronze, spark.table(entry.ledger), entry.key) if entry.ledger else None
    bronze = ledgers.rows_of(bronze, loads) if loads is not None else bronze
    if staged:
        bronze = stage(bronze, f"{run_id}/{entry.key}")
    shapes = shapes or plan_shapes(pipe, bronze)
    for what in ("dropped", "mixed", "unused", "spellings", "keyed"):
        if shapes[0] and getattr(shapes[0], what):
            LOG.warning("%s: %s %s", entry.key, what, ", ".join(getattr(shapes[0], what)))
    shared = f"{run_id}/{entry.key}" if pipe.shared and spark.conf.get("spark.checkpoint.dir", None) else None
    tables = pipeline_tables(pipe, bronze, shapes, spread=pipe.spread, shared=shared)
    named = {table_name(pipe, suffix): df for suffix, df in tables.items()}
    # Named by what doesn't change until the run is noted: a run that broke off replaces its rows when it is run again.
    load = f"{entry.key}@{f'run {entry.runs}' if entry.ledger else entry.low.isoformat() if entry.low else 'start'}"
    counts = write_all(named, source, mode or pipe.write_mode, load, f"{entry.key}@" if entry.low is None and not entry.ledger else None)
    logs.log_audit(bronze, audit, run_id, entry.key, source)
    if loads is not None:
        ledgers.note(loads, entry.ledger, entry.key, load)
    return counts


def run_all(spark: SparkSession, entries: Iterable[Run], audit: str, errors: str,
            sources: Mapping[str, str] | None = None, staged: bool = False) -> dict[str, dict[str, int]]:
    """Run every entry; one that fails is logged and does not stop the others."""
    run_id = str(uuid.uuid4())
    done, failed = {}, {}
    for entry in entries:
        try:
            done[entry.key] = run(spark, entry, audit, run_id, (sources or {}).get(entry.pipeline.name), staged=staged)
        except Exception as e:  # isolated per entry, raised together below
            failed[entry.key] = e
            logs.log_error(spark, errors, run_id, entry.key, e)
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(failed) + len(done)} runs failed: {', '.join(sorted(failed))}")
    return done
