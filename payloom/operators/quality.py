"""Data-quality checks. Each is a lazy one-row result; results are unioned and run together."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.operators.keys import quote

RESULT = ("check_id", "status", "bad_rows")
LOG = logging.getLogger(__name__)


def _result(counted: DataFrame, check_id: str, ok: Column) -> DataFrame:
    """From a one-row frame with column ``n`` to a check result."""
    return counted.select(F.lit(check_id).alias("check_id"), F.when(ok, "PASS").otherwise("FAIL").alias("status"),
                          F.col("n").cast("long").alias("bad_rows"))


def expect_none(bad: DataFrame, check_id: str) -> DataFrame:
    """The frame of bad rows is empty."""
    return _result(bad.agg(F.count(F.lit(1)).alias("n")), check_id, F.col("n") == 0)


def expect_rows(df: DataFrame, check_id: str, where: Column | None = None) -> DataFrame:
    """At least one row (in scope). ``bad_rows`` is 1 for an empty table."""
    df = df if where is None else df.filter(where)
    # One row decides: the scan stops there.
    return _result(df.limit(1).agg((1 - F.count(F.lit(1))).alias("n")), check_id, F.col("n") == 0)


def expect_value(df: DataFrame, check_id: str, value: Column, expected: object) -> DataFrame:
    """An aggregate equals the expected value."""
    return _result(df.agg(F.when(value.eqNullSafe(F.lit(expected)), 0).otherwise(1).alias("n")), check_id,
                   F.col("n") == 0)


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*[F.col(quote(k)) for k in keys]).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def expect_unique(df: DataFrame, keys: Sequence[str], check_id: str) -> DataFrame:
    return expect_none(duplicates(df, keys), check_id)


def expect_not_null(df: DataFrame, columns: Sequence[str], check_id: str) -> DataFrame:
    """One result per column, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(quote(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(f"{check_id}:{c}").alias("check_id"),
            F.when(F.col(f"c{i}") == 0, "PASS").otherwise("FAIL").alias("status"),
            F.col(f"c{i}").alias("bad_rows"))
        for i, c in enumerate(columns)])))


class TableRules(NamedTuple):
    """Checks that rows and keys of one table answer.

    unique: keys without two rows; not_null: columns; exactly: (keys, n) with
    n rows per key; rows: at least one row, `where` within a scope.
    """

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    exactly: tuple[tuple[tuple[str, ...], int], ...] = ()
    rows: bool = True
    where: Column | None = None


def rule_checks(make: Callable[[], DataFrame], name: str, rules: TableRules) -> dict[str, Callable[[], DataFrame]]:
    """The rules of a table as checks by themselves, by id."""
    checks: dict[str, Callable[[], DataFrame]] = {}
    if rules.rows:
        checks[f"{name}:rows"] = lambda: expect_rows(make(), f"{name}:rows", rules.where)
    if rules.unique:
        checks[f"{name}:unique"] = lambda: expect_unique(make(), rules.unique, f"{name}:unique")
    for column in rules.not_null:
        checks[f"{name}:{column}"] = lambda c=column: expect_not_null(make(), (c,), name)
    for keys, n in rules.exactly:
        checks[f"{name}:{n} rows"] = lambda k=keys, n=n: expect_exactly(make(), k, n, f"{name}:{n} rows")
    return checks


def check_table(df: DataFrame, name: str, rules: TableRules) -> DataFrame:
    """Results of all rules of a table from one scan.

    Rows are counted by every set of keys at once (grouping sets, one row per
    key and task before the exchange); empty columns and rows in scope are
    counted beside the keys of the first set. A rule on a column that the
    table lacks is an ERROR row and takes no part.
    """
    has = {c.lower() for c in df.columns}

    def known(columns: Sequence[str]) -> bool:
        return all(c.lower() in has for c in columns)

    wanted = [k for k in (rules.unique, *(k for k, _ in rules.exactly)) if k and known(k)]
    sets = list(dict.fromkeys(tuple(sorted({c.lower() for c in k})) for k in wanted)) or [()]
    columns = sorted({c for s in sets for c in s})
    empty = [c for c in rules.not_null if known((c,))]
    # Renamed, so that a count of empty values reads the column and not the grouping's empty stand-in for it.
    plain = df.select(*[F.col(quote(c)).alias(f"k{i}") for i, c in enumerate(columns)], *[F.col(quote(c)).isNull().alias(f"e{i}") for i, c in enumerate(empty)],
                      (F.lit(True) if rules.where is None else F.coalesce(rules.where, F.lit(False))).alias("inside"))
    counts = [F.count(F.lit(1)).alias("n"), F.count_if("inside").alias("n_inside"), *[F.count_if(f"e{i}").alias(f"n_e{i}") for i in range(len(empty))]]
    place = {c: f"k{i}" for i, c in enumerate(columns)}
    if len(sets) > 1:
        # The bits of a grouping's id tell the columns that it leaves out, the first column's being the highest.
        ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
        counted = plain.groupingSets([[F.col(place[c]) for c in s] for s in sets], *[F.col(place[c]) for c in columns]).agg(F.grouping_id().alias("grouping"), *counts)
    else:
        ids = [0]
        counted = plain.groupBy(*place.values()).agg(F.lit(0).alias("grouping"), *counts)

    def of(keys: Sequence[str], bad: Column) -> Column:
        at = ids[sets.index(tuple(sorted({c.lower() for c in keys})))]
        return F.count_if((F.col("grouping") == at) & bad)

    first = F.col("grouping") == ids[0]
    found: list[tuple[str, Column | None]] = []
    if rules.rows:
        found.append((f"{name}:rows", F.when(F.coalesce(F.sum(F.when(first, F.col("n_inside"))), F.lit(0)) > 0, 0).otherwise(1)))
    if rules.unique:
        found.append((f"{name}:unique", of(rules.unique, F.col("n") > 1) if known(rules.unique) else None))
    for c in rules.not_null:
        found.append((f"{name}:{c}", F.coalesce(F.sum(F.when(first, F.col(f"n_e{empty.index(c)}"))), F.lit(0)) if c in empty else None))
    for keys, n in rules.exactly:
        found.append((f"{name}:{n} rows", of(keys, F.col("n") != n) if known(keys) else None))
    return _results(counted, found)


def _results(counted: DataFrame, found: Sequence[tuple[str, Column | None]]) -> DataFrame:
    """A result row per check from its number of bad rows, an aggregate of the counts; ERROR where there is none."""
    bad = counted.agg(*[(F.lit(None) if b is None else b).cast("long").alias(f"b{i}") for i, (_, b) in enumerate(found)])
    return bad.select(F.inline(F.array(*[
        F.struct(F.lit(check_id).alias("check_id"),
                 F.lit("ERROR").alias("status") if b is None else F.when(F.col(f"b{i}") == 0, "PASS").otherwise("FAIL").alias("status"),
                 F.col(f"b{i}").alias("bad_rows"))
        for i, (check_id, b) in enumerate(found)])))


class Match(NamedTuple):
    """Every row of `left` has a row of `right` with the same values in the columns `on`."""

    check_id: str
    left: DataFrame
    right: DataFrame
    on: tuple[str, ...]


def _folded(columns: Iterable[str]) -> tuple[str, ...]:
    return tuple(sorted({c.lower() for c in columns}))


def _key_sets(rules: TableRules) -> list[tuple[str, ...]]:
    """The sets of keys by which the rules count, the largest first."""
    return sorted({_folded(k) for k in (rules.unique, *(k for k, _ in rules.exactly)) if k}, key=lambda s: (-len(s), s))


def _common_key(tables: Mapping[str, tuple[DataFrame, TableRules]], matches: Sequence[Match]) -> tuple[str, ...] | None:
    """The columns by which all tables are matched, if each table can be counted by ever smaller sets of keys down to these."""
    keys = {_folded(m.on) for m in matches}
    frames = [df for df, _ in tables.values()]
    if len(keys) != 1 or any(all(side is not df for df in frames) for m in matches for side in (m.left, m.right)):
        return None
    on = keys.pop()
    types = set()
    for df, rules in tables.values():
        sets = [*_key_sets(rules), on]
        names = [c.lower() for c in df.columns]
        if any(names.count(c) != 1 for c in _folded((*on, *rules.not_null, *(c for s in sets for c in s)))):
            return None
        if any(not set(small) <= set(large) for large, small in zip(sets, sets[1:])):
            return None
        types.add(tuple(df.schema[names.index(c)].dataType for c in on))
    return on if len(types) == 1 else None


def check_related(tables: Mapping[str, tuple[DataFrame, TableRules]], matches: Sequence[Match]) -> DataFrame:
    """Results of all rules of some tables (by name) and of matches between them, from one query.

    Where the tables are matched by columns that all their keys have, each table is read once: it is counted by its keys,
    these counts by the next smaller keys, and all tables' counts together by the columns of the match, with one row per
    key and task before each exchange. Otherwise the tables are read for each match again.
    """
    on = _common_key(tables, matches)
    if on is None:
        return union_results([*(check_table(df, name, rules) for name, (df, rules) in tables.items()),
                              *(_expect_match(m.left, m.right, m.on, m.check_id) for m in matches)])
    counted: list[tuple[DataFrame, list[str]]] = []
    found: list[tuple[str, Column]] = []
    for j, (name, (df, rules)) in enumerate(tables.items()):
        sets = [s for s in _key_sets(rules) if s != on]
        place = {c: f"k{i}" for i, c in enumerate(_folded((*on, *(c for s in sets for c in s))))}
        inside = F.lit(True) if rules.where is None else F.coalesce(rules.where, F.lit(False))
        counts = {f"t{j}_n": F.lit(1), f"t{j}_inside": inside, **{f"t{j}_e{i}": F.col(quote(c)).isNull() for i, c in enumerate(rules.not_null)}}
        level = df.select(*[F.col(quote(c)).alias(k) for c, k in place.items()], *[c.cast("long").alias(x) for x, c in counts.items()])
        sums, n = list(counts), F.col(f"t{j}_n")
        by_key = [(f"{name}:unique", rules.unique, n > 1)] if rules.unique else []
        by_key += [(f"{name}:{m} rows", keys, n != m) for keys, m in rules.exactly]
        bad: dict[int, Column] = {r: F.count_if((n > 0) & cond) for r, (_, keys, cond) in enumerate(by_key) if _folded(keys) == on}
        for s in sets:
            level = level.groupBy(*[place[c] for c in s]).agg(*[F.sum(x).alias(x) for x in sums])
            here = {f"t{j}_r{r}": cond for r, (_, keys, cond) in enumerate(by_key) if _folded(keys) == s}
            level = level.withColumns({x: cond.cast("long") for x, cond in here.items()})
            sums += here
        bad |= {r: F.coalesce(F.sum(f"t{j}_r{r}"), F.lit(0)) for r in range(len(by_key)) if r not in bad}
        counted.append((level.select(*[F.col(place[c]).alias(f"on{i}") for i, c in enumerate(on)], *sums), sums))
        if rules.rows:
            found.append((f"{name}:rows", F.when(F.coalesce(F.sum(f"t{j}_inside"), F.lit(0)) > 0, 0).otherwise(1)))
        found += [(f"{name}:{c}", F.coalesce(F.sum(f"t{j}_e{i}"), F.lit(0))) for i, c in enumerate(rules.not_null)]
        found += [(check_id, bad[r]) for r, (check_id, _, _) in enumerate(by_key)]
    keys = [f"on{i}" for i in range(len(on))]
    every = [x for _, sums in counted for x in sums]
    parts = [level.select(*keys, *[F.col(x) if x in sums else F.lit(0).cast("long").alias(x) for x in every]) for level, sums in counted]
    by_match = reduce(DataFrame.unionAll, parts).groupBy(*keys).agg(*[F.sum(x).alias(x) for x in every])
    frames = [df for df, _ in tables.values()]
    # An empty value equals no other.
    empty = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    for m in matches:
        left, right = (F.col(f"t{next(j for j, df in enumerate(frames) if df is side)}_n") for side in (m.left, m.right))
        found.append((m.check_id, F.coalesce(F.sum(F.when((right == 0) | empty, left)), F.lit(0))))
    return _results(by_match, found)


class Together(NamedTuple):
    """Checks that share a scan, and the same checks one by one for the case that it fails."""

    make: Callable[[], DataFrame]
    apart: Mapping[str, Callable[[], DataFrame] | Together]


def table_rules(make: Callable[[], DataFrame], name: str, rules: TableRules) -> Together:
    """One scan for the rules of the table that `make` gives."""
    return Together(lambda: check_table(make(), name, rules), rule_checks(make, name, rules))


def _pairs(on: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _match(pairs: Mapping[str, str]) -> Column:
    cond = None
    for i, c in enumerate(pairs):
        eq = F.col(quote(c)) == F.col(f"__p{i}")
        cond = eq if cond is None else cond & eq
    return cond


def _known(parent: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    return parent.select(*[F.col(quote(p)).alias(f"__p{i}") for i, p in enumerate(pairs.values())])


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Child rows whose parent is missing; ``on`` maps child to parent columns."""
    pairs = _pairs(on)
    return child.join(_known(parent, pairs), _match(pairs), "left_anti")


def _expect_match(left: DataFrame, right: DataFrame, on, check_id: str) -> DataFrame:
    # Both sides are reduced to one row per key, on the map side first, so a
    # key with very many rows costs no more than any other.
    pairs = _pairs(on)
    counts = left.groupBy(*[F.col(quote(c)) for c in pairs]).agg(F.count(F.lit(1)).alias("__n"))
    missing = counts.join(_known(right, pairs).distinct(), _match(pairs), "left_anti")
    return _result(missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")), check_id, F.col("n") == 0)


def expect_parent(child: DataFrame, parent: DataFrame, on, check_id: str) -> DataFrame:
    """Every child row has a parent; ``on`` maps child to parent columns."""
    return _expect_match(child, parent, on, check_id)


def expect_children(parent: DataFrame, child: DataFrame, on: Mapping[str, str] | Sequence[str], check_id: str) -> DataFrame:
    """Every parent has at least one child; ``on`` maps parent to child columns."""
    return _expect_match(parent, child, on, check_id)


def wrong_counts(df: DataFrame, keys: Sequence[str], n: int, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) != n)


def expect_exactly(df: DataFrame, keys: Sequence[str], n: int, check_id: str) -> DataFrame:
    """Exactly ``n`` rows per key."""
    return expect_none(wrong_counts(df, keys, n), check_id)


def expect_keys(expected: DataFrame, audit: DataFrame, check_id: str, key: str = "config_name") -> DataFrame:
    """Every expected key occurs in the audit log."""
    return _expect_match(expected, audit, [key], check_id)


def expect_no_errors(errors: DataFrame, check_id: str, keys: Sequence[str] | None = None,
                     step: str = "pipeline_step") -> DataFrame:
    return expect_none(errors if keys is None else errors.filter(F.col(step).isin(*keys)), check_id)


def _chunk_of(df: DataFrame, run: str, chunk: str | int) -> Column:
    if isinstance(df.schema[run].dataType, T.NumericType):
        size = chunk if isinstance(chunk, int) else 1_000_000
        return F.coalesce(F.floor(F.col(quote(run)) / size), F.lit(0)).cast("long")
    return F.coalesce(F.date_trunc(chunk, F.col(quote(run)).cast("timestamp")), F.lit("0001-01-01").cast("timestamp"))


def steps_back(audit: DataFrame, key: str = "config_name", run: str = "flattened_at",
               mark: str = "ingested_at", chunk: str | int = "month") -> DataFrame:
    """Runs whose high-water mark is not above that of the run before.

    ``run`` orders the runs: a time, or a number, whose chunks are ``chunk``
    numbers long (a million where a unit of time is given). Runs are compared within (key, chunk of time); the last run before a chunk
    comes from one row per key and chunk, so no task holds all runs of a key.
    """
    rows = audit.withColumn("__chunk", _chunk_of(audit, run, chunk))
    within = Window.partitionBy(key, "__chunk").orderBy(run, mark)
    ends = rows.groupBy(key, "__chunk").agg(F.max(F.struct(run, mark)).alias("__end"))
    ends = ends.select(key, "__chunk", F.lag("__end").over(Window.partitionBy(key).orderBy("__chunk")).alias("__earlier"))
    known = rows.withColumns({"__before": F.lag(mark).over(within), "__n": F.row_number().over(within)})
    on = F.col("__key").eqNullSafe(F.col(key)) & (F.col("__chunk") == F.col("__c"))
    joined = known.join(ends.toDF("__key", "__c", "__earlier"), on)
    before = F.when(F.col("__n") == 1, F.col("__earlier").getField(mark)).otherwise(F.col("__before"))
    return joined.filter(F.col(mark) <= before).select(*audit.columns)


def expect_advancing(audit: DataFrame, check_id: str, **columns: str) -> DataFrame:
    return expect_none(steps_back(audit, **columns), check_id)


def expect_fresh(df: DataFrame, check_id: str, ts: str = "ingested_at", hours: int = 48,
                 now: Column | None = None) -> DataFrame:
    """The newest row is not older than the limit. A table without a time passes; ``expect_rows`` tells an empty one."""
    now = now if now is not None else F.current_timestamp()
    limit = now - F.make_interval(hours=F.lit(hours))
    newest = df.agg(F.max(ts).alias("newest"))
    return _result(newest.select(F.when(F.col("newest") < limit, 1).otherwise(0).alias("n")), check_id, F.col("n") == 0)


def unresolved(errors: DataFrame, audit: DataFrame, error_key: str = "pipeline_step", error_at: str = "run_timestamp",
               audit_key: str = "config_name", audit_at: str = "flattened_at") -> DataFrame:
    """Keys whose last error is not followed by a success.

    Both logs are reduced to one row per key before they are joined.
    """
    last_error = errors.groupBy(F.col(error_key).alias("key")).agg(F.max(error_at).alias("last_error"))
    last_ok = audit.groupBy(F.col(audit_key).alias("key")).agg(F.max(audit_at).alias("last_success"))
    joined = last_error.join(last_ok, "key", "left")
    return joined.filter(F.col("last_success").isNull() | (F.col("last_success") < F.col("last_error")))


def expect_resolved(errors: DataFrame, audit: DataFrame, check_id: str, **columns: str) -> DataFrame:
    return expect_none(unresolved(errors, audit, **columns), check_id)


def union_results(results: Iterable[DataFrame]) -> DataFrame:
    out = None
    for r in results:
        out = r if out is None else out.unionByName(r)
    if out is None:
        raise ValueError("no checks given")
    return out


def run_checks(spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame] | Together], workers: int = 4) -> DataFrame:
    """Results of all checks, run as jobs of their own, a few at a time.

    A check that cannot be planned or fails while it runs becomes an ERROR row
    and leaves the others alone; checks that share a scan are then run one by
    one. Every check has a few result rows, so what meets on the driver grows
    with the number of checks only.
    """
    def one(check_id: str, make: Callable[[], DataFrame] | Together) -> list[tuple]:
        plan = make.make if isinstance(make, Together) else make
        try:
            return [tuple(r) for r in plan().select(*RESULT).collect()]
        except Exception as e:  # reported, not raised
            LOG.warning("check %s: %s", check_id, e)
            if isinstance(make, Together):
                return [r for c in make.apart.items() for r in one(*c)]
            return [(check_id, "ERROR", None)]

    with ThreadPoolExecutor(workers) as pool:
        found = list(pool.map(lambda c: one(*c), checks.items()))
    return spark.createDataFrame([r for rows in found for r in rows], "check_id string, status string, bad_rows long")


def summarize(results: DataFrame) -> DataFrame:
    """Number of checks per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def assert_passed(results: DataFrame) -> None:
    """Raise if any check failed. The result has one row per check, so it is small."""
    bad = results.filter(F.col("status").isin("FAIL", "ERROR")).collect()
    if bad:
        raise AssertionError(f"{len(bad)} checks did not pass: "
                             + ", ".join(f"{r['check_id']} {r['status']} ({r['bad_rows']})" for r in bad))
