"""Watermarks, run lists and the streaming load."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import functions as F

from payloom.functions.variant import get
from payloom.operators.keys import max_per_key
from payloom.plans.incremental import discover_runs, run_all, run_list, source_watermarks, target_watermarks
from payloom.operators.flatten import flatten
from payloom.plans.spec import AutoTree, Field, Pipeline, Root
from payloom.sinks.compaction import compact, latest_rows
from payloom.sinks.logs import audit_row
from payloom.sinks import logs
from payloom.sinks.tables import write_all, write_table
from payloom.sources.bronze import scope_filter
from payloom.streaming import load_stream, run_available
from payloom.suite.base import bronze_rows, plain_time, query, table, text
from payloom.suite.nested import order_bronze

ORDERS = Pipeline(name="orders", source="bronze.orders", prefix="flat.orders", scope="orders_{competition_id}_{season}")
PARAMS = [{"competition_id": c, "season": str(y)} for c in ("F", "O", "X") for y in (1996, 1999)]


@query("source_watermark", """
SELECT max(o_orderdate) AS high_water FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1998""")
def source_watermark(spark, sf):
    df = order_bronze(spark, sf).filter(
        scope_filter(ORDERS.scope, {"competition_id": "F", "season": "1998"}))
    return plain_time(max_per_key(df, [], "ingested_at"), "high_water")


@query("source_watermarks", """
WITH p AS (SELECT c, s FROM (SELECT unnest(['F', 'O', 'X']) AS c), (SELECT unnest([1996, 1999]) AS s))
SELECT 'orders' AS config_name, c AS competition_id, CAST(s AS varchar) AS season,
       'orders_' || c || '_' || s AS audit_key, max(o_orderdate) AS src_watermark
FROM p LEFT JOIN orders ON o_orderstatus = c AND year(o_orderdate) = s GROUP BY ALL""")
def all_source_watermarks(spark, sf):
    return plain_time(source_watermarks(order_bronze(spark, sf), ORDERS, PARAMS), "src_watermark")


def audit_log(spark, sf):
    """Earlier runs: one per urgent order, under the key of its status and year."""
    return table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O'").select(
        F.concat_ws("_", F.lit("orders"), "o_orderstatus", F.year("o_orderdate")).alias("config_name"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at"))


@query("target_watermarks", """
SELECT 'orders_' || o_orderstatus || '_' || year(o_orderdate) AS audit_key, max(o_orderdate) AS tgt_watermark,
       count(*) AS runs FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O' GROUP BY 1""")
def all_target_watermarks(spark, sf):
    return plain_time(target_watermarks(audit_log(spark, sf)), "tgt_watermark")


@query("run_list", """
WITH p AS (SELECT c, s FROM (SELECT unnest(['F', 'O', 'X']) AS c), (SELECT unnest([1996, 1999]) AS s)),
src AS (SELECT c AS competition_id, CAST(s AS varchar) AS season, 'orders_' || c || '_' || s AS audit_key,
               max(o_orderdate) AS src_watermark
        FROM p LEFT JOIN orders ON o_orderstatus = c AND year(o_orderdate) = s GROUP BY ALL),
tgt AS (SELECT 'orders_' || o_orderstatus || '_' || year(o_orderdate) AS audit_key, max(o_orderdate) AS tgt_watermark
        FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O' GROUP BY 1)
SELECT 'orders' AS config_name, src.*, tgt_watermark FROM src LEFT JOIN tgt USING (audit_key)
WHERE src_watermark IS NOT NULL AND (tgt_watermark IS NULL OR src_watermark > tgt_watermark)""")
def due_runs(spark, sf):
    marks = source_watermarks(order_bronze(spark, sf), ORDERS, PARAMS)
    return plain_time(run_list(marks, audit_log(spark, sf)), "src_watermark", "tgt_watermark")


@query("audit_row", """
SELECT 'r1' AS run_id, 'orders' AS config_name, 'bronze.orders' AS source_table, max(o_orderdate) AS ingested_at
FROM orders""")
def one_audit_row(spark, sf):
    return plain_time(audit_row(order_bronze(spark, sf), "r1", "orders", "bronze.orders").drop("flattened_at"))


EVENTS = Pipeline(
    name="events", source="bronze.events", prefix="flat_events", text=False,
    roots=(Root(table="event", element="event", fields=(
        Field("id", "event_id", "bigint"), Field("k", "k", "bigint"), Field("type", "event_type")),),))


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def _folder(spark, name: str) -> str:
    """A new folder for checkpoints of streams; spark.checkpoint.dir, or the warehouse where it is unset: both are shared."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{_fresh(name)}"


@query("stream_load", """
SELECT event_id, CAST(props->>'k' AS bigint) AS k, event_type, 'user_' || user_id AS ingested_from, ts AS ingested_at,
       'bronze' AS source_schema, 'events' AS source_table_name FROM events""")
def stream_load(spark, sf):
    """The events table as a file stream, flattened batch by batch into its table."""
    path = f"{sf}/events.parquet"
    events = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    pipe = dataclasses.replace(EVENTS, prefix=_fresh("flat_events"))
    load_stream(event_bronze(events), pipe, _folder(spark, "stream_load"))
    return plain_time(spark.table(f"{pipe.prefix}_event").drop("load_key", "target_schema", "target_table_name"))


def event_bronze(events, payload: dict | None = None):
    fields = payload or {"id": F.col("event_id"), "k": get(F.parse_json("props"), "k"), "type": F.col("event_type")}
    return events.select(
        F.concat(F.lit("user_"), "user_id").alias("ingested_from"), F.col("ts").cast("timestamp").alias("ingested_at"),
        F.lit(None).cast("variant").alias("l0payload"), F.lit("event").alias("l1element"),
        F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("payload"))


# Two windows of one feed: the second has decimals, text, booleans and a new field where the first has whole numbers.
GROWING = Pipeline(name="growing", source="bronze.growing", prefix="growing", text=False, raw_names=True,
                   auto=(AutoTree("item", "item"),))
EARLY, LATE = "l_linenumber <= 3", "l_linenumber > 3"


def growing_bronze(spark, sf, late: dict):
    rows = table(spark, sf, "lineitem")
    whole = {"line": text("concat(l_orderkey, '-', l_linenumber)"), "v": "CAST(l_partkey AS bigint)"}
    make = lambda df, shape, at: bronze_rows(df, "concat('growing_', l_orderkey)", at, {"item": ("true", shape)})
    return make(rows.filter(EARLY), whole, "timestamp'2024-01-01'"), make(rows.filter(LATE), {"line": whole["line"], **late}, "timestamp'2024-02-01'")


def loaded_twice(spark, sf, late: dict, *columns: str):
    """Both windows through the runner's sink, one after the other; read back as text, as types are the driver's to compare."""
    target = _fresh("growing")
    for k, bronze in enumerate(growing_bronze(spark, sf, late)):
        write_table(flatten(bronze, GROWING.auto)["item"], target, load=f"growing@{k}")
    return spark.table(target).select("line", *[F.col(c).cast("string").alias(c) for c in columns])


LINE = "l_orderkey || '-' || l_linenumber AS line"


@query("append_widened_numbers", f"""
SELECT {LINE}, CAST(CASE WHEN {EARLY} THEN l_partkey ELSE l_partkey + 0.75 END AS decimal(28, 2))::varchar AS v FROM lineitem""")
def append_widened_numbers(spark, sf):
    """Whole numbers, then numbers with decimals: all of them keep their value."""
    rows = loaded_twice(spark, sf, {"v": "CAST(l_partkey + 0.75BD AS decimal(20, 2))"}, "v")
    return rows.withColumn("v", F.col("v").cast("decimal(28, 2)").cast("string"))


@query("append_text_after_number", f"""
SELECT {LINE}, CASE WHEN {EARLY} THEN l_partkey::varchar ELSE 'p' || l_partkey END AS v,
       CASE WHEN {LATE} THEN l_returnflag END AS added FROM lineitem""")
def append_text_after_number(spark, sf):
    """Whole numbers, then text and a new field."""
    return loaded_twice(spark, sf, {"v": "concat('p', l_partkey)", "added": "l_returnflag"}, "v", "added")


@query("append_boolean_after_number", f"""
SELECT {LINE}, CASE WHEN {EARLY} THEN l_partkey::varchar ELSE (l_partkey % 2 = 0)::varchar END AS v FROM lineitem""")
def append_boolean_after_number(spark, sf):
    return loaded_twice(spark, sf, {"v": "l_partkey % 2 = 0"}, "v")


@query("stream_two_batches", f"""
SELECT {LINE}, CASE WHEN {EARLY} THEN l_partkey::varchar ELSE 'p' || l_partkey END AS v,
       CASE WHEN {LATE} THEN l_returnflag END AS added FROM lineitem""")
def stream_two_batches(spark, sf):
    """The same two windows as files of a stream, without declared shapes."""
    folder, target = _folder(spark, "stream_two"), _fresh("growing")
    pipe = dataclasses.replace(GROWING, prefix=target)
    for bronze in growing_bronze(spark, sf, {"v": "concat('p', l_partkey)", "added": "l_returnflag"}):
        bronze.write.mode("append").parquet(f"{folder}/bronze")
        run_available(spark, pipe, f"{folder}/bronze", f"{folder}/checkpoint")
    return spark.table(f"{target}_item").select("line", "v", "added")


def write_attempts(spark, tables: dict, load: str):
    """A load whose second table breaks at first, then the whole of it again."""
    item, other = tables
    try:
        write_all({item: tables[item], other: tables[other].withColumn("v", F.raise_error(F.lit("driver lost")).cast("bigint"))}, load=load)
    except Exception:
        pass
    else:
        raise AssertionError("the second table was written")
    write_all(tables, load=load)


@query("run_retried", f"""
SELECT t.name AS table_name, {LINE}, l_partkey AS v FROM lineitem, (VALUES ('item'), ('other')) t(name)""")
def run_retried(spark, sf):
    """A run that breaks off after its first table, and is run again whole, leaves both tables with the rows of one run."""
    bronze, late = growing_bronze(spark, sf, {"v": "CAST(l_partkey AS bigint)"})
    target = _fresh("growing")
    item = flatten(bronze.unionByName(late), GROWING.auto)["item"]
    write_attempts(spark, {f"{target}_item": item, f"{target}_other": item}, "growing@start")
    both = [spark.table(f"{target}_{n}").select(F.lit(n).alias("table_name"), "line", "v") for n in ("item", "other")]
    return both[0].unionByName(both[1])


@query("run_after_lost_driver", f"""
SELECT {LINE}, CASE WHEN {EARLY} THEN l_partkey::varchar ELSE 'p' || l_partkey END AS v FROM lineitem""")
def run_after_lost_driver(spark, sf):
    """Files that lost drivers left before the first write, in a load's own folder and in a widening load are no rows."""
    target = _fresh("growing")
    store = f"{spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri}/{target}__a"
    junk = table(spark, sf, "lineitem").select(F.lit("junk").alias("line"), F.col("l_partkey").cast("bigint").alias("v"))
    for path in ("_temporary/0/task", "load_key=growing%400"):
        junk.write.mode("overwrite").parquet(f"{store}/{path}")
    early, late = (flatten(b, GROWING.auto)["item"] for b in growing_bronze(spark, sf, {"v": "concat('p', l_partkey)"}))
    write_table(early, target, load="growing@0")
    for path in (".spark-staging-lost/load_key=growing%401", "load_key=growing%401"):
        junk.write.mode("overwrite").parquet(f"{store}/{path}")
    for attempt in (late.withColumn("v", F.raise_error(F.lit("driver lost")).cast("string")), late):
        try:
            write_table(attempt, target, load="growing@1")
        except Exception:
            pass
    return spark.table(target).select("line", "v")


@query("full_load_after_windows", f"""SELECT {LINE}, l_partkey AS v FROM lineitem""")
def full_load_after_windows(spark, sf):
    """A first load, a window, then a load of everything from the start: each line once."""
    target = _fresh("growing")
    early, late = growing_bronze(spark, sf, {"v": "CAST(l_partkey AS bigint)"})
    for bronze, load in ((early, "growing@start"), (late, "growing@2024-01-01T00:00:00"), (early.unionByName(late), "growing@start")):
        write_table(flatten(bronze, GROWING.auto)["item"], target, load=load, supersedes="growing@" if load.endswith("start") else None)
    return spark.table(target).select("line", "v")


@query("three_windows_as_one", f"""
SELECT {LINE}, CASE l_linenumber % 3 WHEN 0 THEN l_partkey::varchar WHEN 1 THEN l_partkey || CASE WHEN l_partkey % 2 = 0 THEN '.25' ELSE '.5' END ELSE 'p' || l_partkey END AS v FROM lineitem""")
def three_windows_as_one(spark, sf):
    """Whole numbers, then decimals, then text: the text of all of them is what the payload said, as in one load of all."""
    rows, target = table(spark, sf, "lineitem"), _fresh("growing")
    shapes = ("CAST(l_partkey AS bigint)", "CAST(l_partkey AS decimal(20, 2)) + IF(l_partkey % 2 = 0, 0.25BD, 0.50BD)", "concat('p', l_partkey)")
    for k, v in enumerate(shapes):
        bronze = bronze_rows(rows.filter(f"l_linenumber % 3 = {k}"), "concat('growing_', l_orderkey)", "timestamp'2024-01-01'",
                             {"item": ("true", {"line": text("concat(l_orderkey, '-', l_linenumber)"), "v": v})})
        write_table(flatten(bronze, GROWING.auto)["item"], target, load=f"growing@{k}")
    return spark.table(target).select("line", "v")


@query("compacted_equals_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate AS ingested_at FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""")
def compacted_equals_latest(spark, sf):
    """Four loads, compacted after the second and the third: base and open loads give the newest row of each key."""
    target, keys, tie = _fresh("lines"), ("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_quantity")
    rows = table(spark, sf, "lineitem").select(*keys, *tie, F.col("l_shipdate").alias("ingested_at"))
    for k in range(4):
        write_table(rows.filter(f"(l_partkey + l_suppkey) % 4 = {k}"), target, load=f"lines@{k}")
        if k in (1, 2):
            compact(spark, target, keys, buckets=8, tiebreak=tie)
    return latest_rows(spark, target, keys, tiebreak=tie).select(*keys, *tie, "ingested_at")


@query("late_rows_loaded", f"""SELECT {LINE}, l_partkey AS v FROM lineitem""")
def late_rows_loaded(spark, sf):
    """Loads from several days, of which the oldest arrive last: with a ledger each line is loaded once."""
    name = _fresh("late")
    source, pipe = f"{_folder(spark, 'late_source')}/bronze", dataclasses.replace(GROWING, name=name, prefix=name, source="")
    logs.create_logs(spark, f"{name}_audit", f"{name}_errors")
    shape = {"line": text("concat(l_orderkey, '-', l_linenumber)"), "v": "CAST(l_partkey AS bigint)"}
    for days in ((4, 5), (6, 7), (1, 2, 3)):
        rows = table(spark, sf, "lineitem").filter(F.col("l_linenumber").isin(*days))
        bronze = bronze_rows(rows, "concat('late_', l_orderkey % 10)", "timestampadd(DAY, l_linenumber, timestamp'2024-01-01')", {"item": ("true", shape)})
        bronze.write.mode("append").parquet(source)
        due = discover_runs(spark, [pipe], f"{name}_audit", sources={name: source}, ledger=f"{name}_ledger")
        run_all(spark, due, f"{name}_audit", f"{name}_errors", {name: source})
    left = discover_runs(spark, [pipe], f"{name}_audit", sources={name: source}, ledger=f"{name}_ledger")
    if left:
        raise AssertionError("loads are due that were processed")
    return spark.table(f"{name}_item").select("line", "v")
