"""Slowly changing dimensions, type 1 and type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.operators.keys import latest, quote, row_hash

AUDIT = ("_source_table", "_loaded_at", "_updated_at")


def surrogate_key(keys: Sequence[str], valid_from: str, zoned: bool = True) -> Column:
    """Hash of natural key and start of validity; depends on source time only, so re-runs agree.

    The time counts as microseconds since 1970, whatever zone a session is in and whichever
    clock changed. Key parts have their length before them and a missing one is
    a mark of its own, so no two keys have one text. ``zoned``: the time is an instant, not a wall-clock time.
    """
    texts = [F.col(quote(k)).cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    at = F.unix_micros(valid_from) if zoned else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(valid_from))
    return F.sha2(F.concat(*parts, F.lit("@"), F.coalesce(at.cast("string"), F.lit("-"))), 256)


def with_audit(df: DataFrame, source: str, loaded_at: Column | None = None) -> DataFrame:
    now = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.withColumns({"_source_table": F.lit(source), "_loaded_at": now, "_updated_at": now})


def scd1(new: DataFrame, keys: Sequence[str], order: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """Newest version per key out of new and existing rows.

    With audit columns present, the first load time survives and the update
    time is that of the newest row. Write the result over a new location and
    swap, or into another table: it reads ``existing``.
    """
    rows = new if existing is None else new.unionByName(existing, allowMissingColumns=True)
    if not set(AUDIT) <= set(rows.columns):
        return latest(rows, keys, order, tiebreak=())
    # One pass: the newest row and the oldest load time per key, pre-reduced per task.
    ranked = [*order, "_updated_at"]
    ranked += [c for c in rows.columns if c not in (*keys, *ranked, "_loaded_at")]
    newest = F.struct(*[F.col(quote(c)) for c in ranked])
    picked = rows.groupBy(*keys).agg(F.max(newest).alias("row"), F.min("_loaded_at").alias("_loaded_at"))
    return picked.select(*[
        F.col(c) if c in keys or c == "_loaded_at" else F.col("row").getField(c).alias(c) for c in rows.columns])


def scd2(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, order: Sequence[str] = (),
         chunk: str = "day", sk: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Version ranges: a new row whenever a tracked column changes.

    Output: keys, tracked, ``carry`` (as of the change), ``valid_from``,
    ``valid_to``, ``is_current`` and a surrogate key. Of several rows with the
    same key and time the one first in ``order`` counts; rows without a time
    are left out.

    No task ever holds all rows of a key. Changes are found within (key,
    chunk of time); only the state at both ends of each chunk is compared
    across chunks. A key with very many rows is spread over its chunks.
    """
    steps = scd2_steps(df, keys, tracked, ts, order, chunk, carry)
    return scd2_versions(steps, keys, tracked, sk, carry)


def _chunked(df: DataFrame, keys: Sequence[str], ts: str, chunk: str) -> DataFrame:
    return df.filter(F.col(quote(ts)).isNotNull()).withColumns({
        "__k": F.struct(*[F.col(quote(k)) for k in keys]), "__chunk": F.date_trunc(chunk, F.col(quote(ts)))})


def scd2_steps(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, order: Sequence[str] = (),
               chunk: str = "day", carry: Sequence[str] = ()) -> DataFrame:
    """The first row of each (key, chunk of time) and every change within one: what ``scd2`` makes its versions of.

    As a stored table it is the state that ``late_steps`` maintains. Parameters as for ``scd2``.
    """
    # One shuffle of the rows: by (key, chunk). Equal times, changes and the ends of a chunk are all found there,
    # and the few rows that go across chunks come back by the same key. A struct is never NULL, so missing key
    # parts are compared like values.
    rows = _chunked(df, keys, ts, chunk).withColumn("__hash", row_hash(df, (*keys, ts)))
    by_time = Window.partitionBy("__k", "__chunk").orderBy(
        F.col(quote(ts)), *[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order], "__hash")
    rows = rows.withColumn("__same", F.lag(F.col(quote(ts))).over(by_time)).filter(F.col("__same").isNull() | (F.col("__same") < F.col(quote(ts))))
    state = F.struct(*[F.col(quote(c)) for c in tracked])
    rows = rows.select("__k", "__chunk", F.col(quote(ts)).alias("__at"), state.alias("__state"), *[F.col(quote(c)) for c in carry])
    in_chunk = Window.partitionBy("__k", "__chunk").orderBy("__at")
    return rows.withColumns({
        "__n": F.row_number().over(in_chunk), "__prev": F.lag("__state").over(in_chunk)
    }).filter((F.col("__n") == 1) | ~F.col("__state").eqNullSafe(F.col("__prev"))).withColumn(
        "__next", F.lead("__at").over(in_chunk)).drop("__prev")


def scd2_versions(steps: DataFrame, keys: Sequence[str], tracked: Sequence[str], sk: str | None = None,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Version ranges out of steps; rows between them are not needed."""
    # One row per key and chunk: what it starts with, its first inner change, what it ends with.
    ends = steps.groupBy("__k", "__chunk").agg(
        F.min("__at").alias("__first"), F.min_by("__state", "__at").alias("__start"),
        F.min(F.when(F.col("__n") > 1, F.col("__at"))).alias("__second"), F.max_by("__state", "__at").alias("__end"))
    by_chunk = Window.partitionBy("__k").orderBy("__chunk")
    ends = ends.withColumn("__before", F.lag(F.struct("__end")).over(by_chunk))
    opens = F.col("__before").isNull() | ~F.col("__start").eqNullSafe(F.col("__before.__end"))
    ends = ends.withColumns({
        "__opens": opens, "__change": F.when(opens, F.col("__first")).otherwise(F.col("__second"))
    }).withColumn("__later", F.min("__change").over(by_chunk.rowsBetween(1, Window.unboundedFollowing)))
    kept = steps.join(ends.select("__k", "__chunk", "__opens", "__later"), ["__k", "__chunk"]).filter((F.col("__n") > 1) | F.col("__opens"))
    out = kept.select(
        *[F.col("__k").getField(k).alias(k) for k in keys], *[F.col("__state").getField(c).alias(c) for c in tracked],
        *[F.col(quote(c)) for c in carry], F.col("__at").alias("valid_from"),
        F.coalesce("__next", "__later").alias("valid_to"))
    out = out.withColumn("is_current", F.col("valid_to").isNull())
    zoned = not isinstance(steps.schema["__at"].dataType, T.TimestampNTZType)
    return out.withColumn(sk, surrogate_key(keys, "valid_from", zoned)) if sk else out


def late_steps(rows: DataFrame, new: DataFrame, steps: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str,
               order: Sequence[str] = (), chunk: str = "day", carry: Sequence[str] = ()) -> DataFrame:
    """Steps after a load that may be older than stored rows: those of one build over all rows.

    ``rows`` are the rows of all loads, those of ``new`` among them, and
    ``steps`` what was stored before this load. Only (key, chunk) pairs that
    the load touches are built again, from their rows; the steps of all others
    stay. So loads may come in any order, and a load that comes again changes
    nothing. An empty load gives the stored steps. Rows without a time are
    left out. Write the result next to the old steps and swap: it reads them.
    """
    touched = _chunked(new, keys, ts, chunk).select("__k", "__chunk").distinct()
    again = _chunked(rows, keys, ts, chunk).join(touched, ["__k", "__chunk"], "left_semi").drop("__k", "__chunk")
    redone = scd2_steps(again, keys, tracked, ts, order, chunk, carry)
    return steps.join(touched, ["__k", "__chunk"], "left_anti").unionByName(redone)


def carry_forward(df: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str, chunk: str = "year") -> DataFrame:
    """Each row with the last known value of every column up to its time, per key.

    Within (key, chunk of time) by a running window; what earlier chunks of a
    key end with comes from one row per key and chunk. Missing key parts are a
    key like others; a row without time stays as it is and hands nothing on.
    """
    # A struct is never NULL, so rows with missing key parts or times find their chunk.
    rows = df.withColumns({"__k": F.struct(*[F.col(quote(k)) for k in keys]), "__chunk": F.struct(F.date_trunc(chunk, F.col(quote(ts))).alias("at"))})
    running = Window.partitionBy("__k", "__chunk").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy("__k", "__chunk").agg(*[
        F.max_by(F.col(quote(c)), F.when(F.col(quote(c)).isNotNull(), F.col(quote(ts)))).alias(f"__e_{c}") for c in columns])
    earlier = Window.partitionBy("__k").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("__k", "__chunk", *[F.last(f"__e_{c}", ignorenulls=True).over(earlier).alias(f"__b_{c}") for c in columns])
    timed = F.col(quote(ts)).isNotNull()
    filled = rows.withColumns({f"__r_{c}": F.when(timed, F.last(F.col(quote(c)), ignorenulls=True).over(running)).otherwise(F.col(quote(c))) for c in columns})
    joined = filled.join(ends, ["__k", "__chunk"])
    return joined.select(*[F.coalesce(f"__r_{c}", f"__b_{c}").alias(c) if c in columns else F.col(quote(c)) for c in df.columns])


def known_steps(df: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str, order: Sequence[Column] = (), chunk: str = "year") -> DataFrame:
    """The rows at which a column changes or a chunk of time begins, each with the last known value of every column.

    What ``scd2`` makes of them is what it makes of all rows with their gaps
    filled by ``carry_forward``, from one shuffle of the rows. Of several rows
    with one key and time the values of the one last in ``order`` count where
    it has any, and ties fall to a hash of the row. Rows without a time are left out.
    """
    rows = _chunked(df, keys, ts, chunk).withColumn("__hash", row_hash(df, (*keys, ts)))
    by_time = Window.partitionBy("__k", "__chunk").orderBy(F.col(quote(ts)), *order, "__hash")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    known = F.struct(*[F.last(F.col(quote(c)), ignorenulls=True).over(so_far).alias(c) for c in columns])
    rows = rows.withColumns({"__known": known, "__later": F.lead(F.col(quote(ts))).over(by_time)})
    rows = rows.filter(F.col("__later").isNull() | (F.col("__later") > F.col(quote(ts))))
    # What a chunk does not know yet can only come from before it: a row that brings a chunk nothing new is no change.
    in_chunk = Window.partitionBy("__k", "__chunk").orderBy(F.col(quote(ts)))
    rows = rows.withColumn("__prev", F.lag(F.struct("__known")).over(in_chunk))
    rows = rows.filter(F.col("__prev").isNull() | ~F.col("__known").eqNullSafe(F.col("__prev.__known"))).drop("__prev", "__later", "__hash")

    ends = rows.groupBy("__k", "__chunk").agg(F.max_by("__known", F.col(quote(ts))).alias("__end"))
    earlier = Window.partitionBy("__k").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = F.struct(*[F.last(F.col("__end").getField(c), ignorenulls=True).over(earlier).alias(c) for c in columns])
    joined = rows.join(ends.select("__k", "__chunk", before.alias("__before")), ["__k", "__chunk"])
    return joined.select(*[
        F.coalesce(F.col("__known").getField(c), F.col("__before").getField(c)).alias(c) if c in columns else F.col(quote(c)) for c in df.columns])


def fallback(primary: DataFrame, secondary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the primary source plus those of the secondary whose key it lacks."""
    only = secondary.join(primary.select(*keys).distinct(), list(keys), "left_anti")
    return primary.unionByName(only, allowMissingColumns=True)
