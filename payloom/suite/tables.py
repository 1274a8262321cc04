"""One row per key, dimensions and data-quality checks over the plain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.operators import keys as K
from payloom.operators import quality as Q
from payloom.operators.scd import fallback, late_steps, scd1, scd2, scd2_steps, scd2_versions as versions_of
from payloom.suite.base import ORACLES, query, table

ITEM = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"
ITEM_COLS = tuple(c.strip() for c in ITEM.split(","))


def items(spark, sf):
    return table(spark, sf, "lineitem").select(*ITEM_COLS)


@query("latest_per_key", f"""
SELECT {ITEM} FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""")
def latest_per_key(spark, sf):
    return K.latest(items(spark, sf), ("l_orderkey", "l_linenumber"), ("l_shipdate",),
                    ("l_partkey", "l_suppkey", "l_quantity"))


@query("first_per_key", f"""
SELECT {ITEM} FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity) = 1""")
def first_per_key(spark, sf):
    return K.first(items(spark, sf), ("l_orderkey",),
                   ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))


@query("merge_rows", """
SELECT o_custkey,
       arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus <> 'P') AS status,
       arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority
FROM orders GROUP BY 1""")
def merge_rows(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    return K.merge_rows(df, ("o_custkey",), ("o_orderdate", "o_orderkey"), ("status", "priority"))


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return K.distinct_on(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("distinct_on_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1""")
def distinct_on_key(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return K.distinct_on(df, ("l_orderkey", "l_linenumber"))


@query("newest_rows", """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 20""")
def newest_rows(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type").orderBy(F.desc("ts"), "event_id").limit(20)


@query("scd1_latest", """
SELECT user_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def scd1_latest(spark, sf):
    return scd1(table(spark, sf, "events").select("user_id", "event_type", "value", "ts"), ("user_id",), ("ts",))


@query("scd1_upsert", """
SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, max(o_orderdate) AS seen,
       'orders' AS _source_table, min(o_orderdate) AS _loaded_at, max(o_orderdate) AS _updated_at
FROM orders GROUP BY 1""")
def scd1_upsert(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("seen"), "o_orderkey",
        F.lit("orders").alias("_source_table"), F.col("o_orderdate").alias("_loaded_at"),
        F.col("o_orderdate").alias("_updated_at"))
    old = F.col("seen") < F.lit("1998-01-01")
    return scd1(df.filter(~old), ("o_custkey",), ("seen", "o_orderkey"), existing=df.filter(old)).drop("o_orderkey")


SCD2_SQL = """
WITH s AS (
  SELECT {key}, {tracked}, {ts} AS valid_from,
         lag({tracked}) OVER w AS prev, row_number() OVER w AS n
  FROM ({rows}) WINDOW w AS (PARTITION BY {key} ORDER BY {ts}))
SELECT {key}, {tracked}, valid_from, lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) IS NULL AS is_current
FROM s WHERE n = 1 OR {tracked} IS DISTINCT FROM prev"""


@query("scd2_versions", SCD2_SQL.format(key="user_id", tracked="event_type", ts="ts", rows="SELECT * FROM events"))
def scd2_versions(spark, sf):
    return scd2(table(spark, sf, "events"), ("user_id",), ("event_type",), "ts")


@query("scd2_late_rows", ORACLES["scd2_versions"])
def scd2_late_rows(spark, sf):
    """The newest events first, then two loads whose rows lie between stored ones and before them."""
    events = table(spark, sf, "events")
    newest, odd = F.col("ts") > F.expr("timestamp_ntz'2024-01-16'"), F.col("event_id") % 2 == 1
    loads = [events.filter(newest & odd), events.filter(odd & ~newest), events.filter(~odd)]
    rows, steps = loads[0], scd2_steps(loads[0], ("user_id",), ("event_type",), "ts")
    for load in loads[1:]:
        rows = rows.unionByName(load)
        steps = late_steps(rows, load, steps, ("user_id",), ("event_type",), "ts")
    return versions_of(steps, ("user_id",), ("event_type",))


@query("scd2_surrogate_key", """
WITH u AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1),
s AS (SELECT *, lag(o_orderstatus) OVER w AS p1, lag(o_orderpriority) OVER w AS p2, row_number() OVER w AS n
  FROM u WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))
SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, o_orderdate AS valid_from,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) IS NULL AS is_current,
       sha256(strlen(o_custkey::VARCHAR) || ':' || o_custkey || '@' || epoch_us(o_orderdate)) AS cust_sk
FROM s WHERE n = 1 OR o_orderstatus IS DISTINCT FROM p1 OR o_orderpriority IS DISTINCT FROM p2""")
def scd2_surrogate_key(spark, sf):
    return scd2(table(spark, sf, "orders"), ("o_custkey",), ("o_orderstatus", "o_orderpriority"), "o_orderdate",
                order=("o_orderkey",), chunk="year", sk="cust_sk", carry=("o_orderkey",))


@query("dim_fallback_source", """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier UNION ALL
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def dim_fallback_source(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation")
    c = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation")
    return fallback(s, c, ("id",))


@query("dim_two_sources", """
SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3""")
def dim_two_sources(spark, sf):
    r = table(spark, sf, "region").filter("r_regionkey < 3")
    n = table(spark, sf, "nation")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")


# Data quality -------------------------------------------------------------------

def _status(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST({n} AS bigint) AS bad_rows"


@query("dq_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dq_duplicate_keys(spark, sf):
    return Q.duplicates(table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"))


@query("dq_unique", f"""
SELECT 'items' AS check_id, {_status('n')} FROM (SELECT count(*) AS n FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) UNION ALL
SELECT 'orders', 'PASS', 0""")
def dq_unique(spark, sf):
    return Q.union_results([
        Q.expect_unique(table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"), "items"),
        Q.expect_unique(table(spark, sf, "orders"), ("o_orderkey",), "orders")])


@query("dq_null_keys", f"""
SELECT 'o:o_orderkey' AS check_id, {_status('count(*) FILTER (WHERE o_orderkey IS NULL)')} FROM orders UNION ALL
SELECT 'o:status', {_status("count(*) FILTER (WHERE o_orderstatus = 'P')")} FROM orders""")
def dq_null_keys(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return Q.expect_not_null(df, ("o_orderkey", "status"), "o")


@query("dq_orphans", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""")
def dq_orphans(spark, sf):
    parents = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return Q.orphans(table(spark, sf, "lineitem"), parents, {"l_orderkey": "o_orderkey"}).select(
        "l_orderkey", "l_linenumber")


@query("dq_parent_without_child", f"""
SELECT 'orders_have_items' AS check_id, {_status('count(*)')} FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def dq_parent_without_child(spark, sf):
    return Q.expect_children(table(spark, sf, "orders"), table(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"},
                             "orders_have_items")


@query("dq_child_without_parent", "SELECT 'items_have_orders' AS check_id, 'PASS' AS status, 0::bigint AS bad_rows")
def dq_child_without_parent(spark, sf):
    return Q.expect_parent(table(spark, sf, "lineitem"), table(spark, sf, "orders"), {"l_orderkey": "o_orderkey"},
                           "items_have_orders")


@query("dq_exact_children", f"""
SELECT 'five_nations' AS check_id, {_status('count(*)')} FROM (
  SELECT n_regionkey FROM nation GROUP BY 1 HAVING count(*) <> 5) UNION ALL
SELECT 'two_items', {_status('count(*)')} FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) <> 2)""")
def dq_exact_children(spark, sf):
    return Q.union_results([
        Q.expect_exactly(table(spark, sf, "nation"), ("n_regionkey",), 5, "five_nations"),
        Q.expect_exactly(table(spark, sf, "lineitem"), ("l_orderkey",), 2, "two_items")])


@query("dq_non_empty", """
SELECT 'events' AS check_id, 'PASS' AS status, 0::bigint AS bad_rows UNION ALL
SELECT 'late_events', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END
FROM events WHERE ts > TIMESTAMP '2030-01-01'""")
def dq_non_empty(spark, sf):
    df = table(spark, sf, "events")
    return Q.union_results([Q.expect_rows(df, "events"),
                            Q.expect_rows(df, "late_events", F.col("ts") > F.lit("2030-01-01"))])


@query("dq_value", """
SELECT 'regions' AS check_id, CASE WHEN count(*) = 5 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN count(*) = 5 THEN 0 ELSE 1 END::bigint AS bad_rows FROM region UNION ALL
SELECT 'nations', CASE WHEN max(n_name) = 'x' THEN 'PASS' ELSE 'FAIL' END, CASE WHEN max(n_name) = 'x' THEN 0 ELSE 1 END
FROM nation""")
def dq_value(spark, sf):
    return Q.union_results([
        Q.expect_value(table(spark, sf, "region"), "regions", F.count(F.lit(1)), 5),
        Q.expect_value(table(spark, sf, "nation"), "nations", F.max("n_name"), "x")])


@query("dq_freshness", """
SELECT 'fresh' AS check_id, CASE WHEN max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 48 HOURS THEN 'FAIL' ELSE 'PASS' END
       AS status, CASE WHEN max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 48 HOURS THEN 1 ELSE 0 END::bigint AS bad_rows
FROM events UNION ALL
SELECT 'stale', CASE WHEN max(ts) < TIMESTAMP '2024-03-01' - INTERVAL 48 HOURS THEN 'FAIL' ELSE 'PASS' END,
       CASE WHEN max(ts) < TIMESTAMP '2024-03-01' - INTERVAL 48 HOURS THEN 1 ELSE 0 END FROM events""")
def dq_freshness(spark, sf):
    df = table(spark, sf, "events")
    return Q.union_results([
        Q.expect_fresh(df, "fresh", "ts", 48, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")),
        Q.expect_fresh(df, "stale", "ts", 48, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))])


@query("dq_expected_keys", f"""
SELECT 'statuses' AS check_id, 'PASS' AS status, 0::bigint AS bad_rows UNION ALL
SELECT 'customers', {_status('count(*)')} FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def dq_expected_keys(spark, sf):
    o = table(spark, sf, "orders")
    return Q.union_results([
        Q.expect_keys(o.select("o_orderstatus").distinct(), o, "statuses", "o_orderstatus"),
        Q.expect_keys(table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey"),
                      o.filter("o_orderpriority = '1-URGENT'"), "customers", "o_custkey")])


@query("dq_no_errors", f"""
SELECT 'no_errors' AS check_id, {_status("count(*) FILTER (WHERE event_type = 'error')")} FROM events UNION ALL
SELECT 'no_crashes', 'PASS', 0""")
def dq_no_errors(spark, sf):
    df = table(spark, sf, "events")
    return Q.union_results([Q.expect_no_errors(df, "no_errors", ["error"], "event_type"),
                            Q.expect_no_errors(df, "no_crashes", ["crash"], "event_type")])


@query("dq_advancing", f"""
SELECT 'marks_advance' AS check_id, {_status('count(*)')} FROM (
  SELECT o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders)
WHERE o_orderdate <= p""")
def dq_advancing(spark, sf):
    return Q.expect_advancing(table(spark, sf, "orders"), "marks_advance", key="o_custkey", run="o_orderkey",
                              mark="o_orderdate")


@query("dq_unresolved_errors", """
SELECT e.user_id AS key, e.last_error, a.last_success FROM
  (SELECT user_id, max(ts) AS last_error FROM events WHERE event_type = 'error' GROUP BY 1) e LEFT JOIN
  (SELECT user_id, max(ts) AS last_success FROM events WHERE event_type = 'purchase' GROUP BY 1) a USING (user_id)
WHERE a.last_success IS NULL OR a.last_success < e.last_error""")
def dq_unresolved_errors(spark, sf):
    df = table(spark, sf, "events")
    return Q.unresolved(df.filter("event_type = 'error'"), df.filter("event_type = 'purchase'"), "user_id", "ts",
                        "user_id", "ts")


@query("dq_audit_integrity", f"""
SELECT 'one_run_per_mark' AS check_id, {_status('count(*)')} FROM (
  SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1) UNION ALL
SELECT 'mark:o_orderdate', 'PASS', 0 UNION ALL
SELECT 'errors_resolved', {_status('count(*)')} FROM (
  SELECT user_id, max(ts) FILTER (WHERE event_type = 'error') AS e, max(ts) FILTER (WHERE event_type = 'view') AS v
  FROM events GROUP BY 1) WHERE e IS NOT NULL AND (v IS NULL OR v < e)""")
def dq_audit_integrity(spark, sf):
    o, e = table(spark, sf, "orders"), table(spark, sf, "events")
    return Q.union_results([
        Q.expect_unique(o, ("o_custkey", "o_orderdate"), "one_run_per_mark"),
        Q.expect_not_null(o, ("o_orderdate",), "mark"),
        Q.expect_resolved(e.filter("event_type = 'error'"), e.filter("event_type = 'view'"), "errors_resolved",
                          error_key="user_id", error_at="ts", audit_key="user_id", audit_at="ts")])


@query("dq_summary", """
SELECT status, count(*) AS n_checks FROM (
  SELECT CASE WHEN count(*) > count(DISTINCT (l_orderkey, l_linenumber)) THEN 'FAIL' ELSE 'PASS' END AS status FROM lineitem
  UNION ALL SELECT 'PASS' UNION ALL SELECT 'PASS' UNION ALL SELECT 'ERROR') GROUP BY 1""")
def dq_summary(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return Q.summarize(Q.run_checks(spark, {
        "unique_items": lambda: Q.expect_unique(li, ("l_orderkey", "l_linenumber"), "unique_items"),
        "unique_orders": lambda: Q.expect_unique(o, ("o_orderkey",), "unique_orders"),
        "items": lambda: Q.expect_rows(li, "items"),
        "missing_table": lambda: Q.expect_rows(spark.table("no_such_table"), "missing_table"),
    }))


