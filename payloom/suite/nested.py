"""Scans, coercion, explodes, tree flatten, profiling and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.functions.text import audit_key, snake_case_column
from payloom.functions.variant import as_list, get, present, scalar_text, text_node, unwrap_or_self
from payloom.operators import reshape as R
from payloom.operators.flatten import discover, flatten
from payloom.operators.schema import profile_paths
from payloom.plans.spec import AutoTree
from payloom.sinks.tables import stamp_lineage
from payloom.sources.bronze import all_of, scope_filter, select_element, window_filter
from payloom.suite.base import Either, Repeat, bronze_rows, plain_time, query, table, variant

# Shapes of one order: the payload root is an object, a wrapper or a list; line
# items are an empty list, one bare object, or a list; three levels deep.
ORDER = {
    "orderKey": "o_orderkey", "totalPrice": "o_totalprice", "orderPriority": "o_orderpriority", "note": "cast(null as string)",
    "score": {"points": "o_orderkey % 10", "tries": "o_orderkey % 3"},
    "lineItems": {"lineItem": Either(
        "o_orderkey % 4 = 1",
        {"lineNumber": "1", "partKey": "o_custkey * 10 + 1", "subs": {"sub": {"code": "'a'"}}},
        Repeat("o_orderkey % 4", {
            "lineNumber": "i", "partKey": "o_custkey * 10 + i",
            "subs": {"sub": [{"code": "'a'"}, {"code": "'b'"}]}}),
    )},
}
ORDER_ID = "concat('orders_', o_orderstatus, '_', year(o_orderdate), '_', o_orderkey)"


def order_bronze(spark: SparkSession, sf: str) -> DataFrame:
    root = Either("o_orderkey % 3 = 0", {"order": ORDER}, Either("o_orderkey % 3 = 1", [ORDER], ORDER))
    return bronze_rows(
        table(spark, sf, "orders"), ORDER_ID, "o_orderdate",
        {"order": ("true", root), "empty": ("o_orderkey % 5 = 0", None)},
        l0=Either("o_orderkey % 7 = 0", None, {"custKey": "o_custkey", "orderStatus": "o_orderstatus"}))


ORDER_TREE = AutoTree(
    "order", "order", force_list=frozenset({"order", "lineItem", "sub"}), flatten_structs={"score": "score_"},
    keys={"order": ("order_key",), "lineItem": ("order_key", "line_number")})


def orders_unwrapped(spark: SparkSession, sf: str) -> DataFrame:
    """The order bronze with the optional wrapper taken off, L0 payload kept."""
    df = order_bronze(spark, sf)
    return df.withColumn("payload", unwrap_or_self("payload", "order"))


ITEMS_SQL = """
  SELECT o.*, i.i AS line_number, o_custkey * 10 + i.i AS part_key
  FROM orders o, (SELECT unnest([1, 2, 3]) AS i) i WHERE i.i <= o_orderkey % 4"""
ID_SQL = "'orders_' || o_orderstatus || '_' || year(o_orderdate) || '_' || o_orderkey"


@query("flatten_orders", f"""
SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderpriority AS order_priority,
       CAST(NULL AS varchar) AS note, o_orderkey % 10 AS score_points, o_orderkey % 3 AS score_tries,
       o_orderdate AS ingested_at, {ID_SQL} AS ingested_from,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust_key,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS order_status
FROM orders""")
def flatten_orders(spark, sf):
    return plain_time(flatten(orders_unwrapped(spark, sf), ORDER_TREE)["order"])


@query("flatten_line_items", f"""
SELECT order_key, line_number, part_key, ingested_at, ingested_from, cust_key, order_status FROM (
  SELECT o_orderkey AS order_key, line_number, part_key, o_orderdate AS ingested_at, {ID_SQL} AS ingested_from,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust_key,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS order_status
  FROM ({ITEMS_SQL}))""")
def flatten_line_items(spark, sf):
    return plain_time(flatten(orders_unwrapped(spark, sf), ORDER_TREE)["line_item"])


@query("flatten_three_levels", f"""
SELECT o_orderkey AS order_key, line_number, s.code
FROM ({ITEMS_SQL}) l, (SELECT unnest(['a', 'b']) AS code) s
WHERE s.code = 'a' OR l.o_orderkey % 4 <> 1""")
def flatten_three_levels(spark, sf):
    return flatten(orders_unwrapped(spark, sf), ORDER_TREE)["sub"].select("order_key", "line_number", "code")


@query("flatten_options", """
SELECT CAST(o_orderkey AS varchar) AS order_key, 'tpc' AS feed,
       'orders_' || o_orderstatus || '_' || year(o_orderdate) || '_' || o_orderkey AS ingested_from
FROM orders""")
def flatten_options(spark, sf):
    tree = AutoTree("order", "order", exclude=frozenset({"score", "totalPrice", "orderPriority", "note", "lineItems"}),
                    static={"feed": "tpc"}, type_overrides={"order_key": "string"},
                    passthrough=("ingested_from", "feed"))
    return flatten(orders_unwrapped(spark, sf), tree)["order"]


@query("flatten_suppressed_root", f"SELECT line_number, count(*) AS n FROM ({ITEMS_SQL}) GROUP BY 1")
def flatten_suppressed_root(spark, sf):
    tree = AutoTree("order", "order", force_list=frozenset({"lineItem"}), suppress=frozenset({"order"}))
    tables = flatten(orders_unwrapped(spark, sf), tree)
    assert "order" not in tables
    return tables["line_item"].groupBy("line_number").agg(F.count(F.lit(1)).alias("n"))


@query("l0_first_element", "SELECT o_orderkey AS order_key, o_custkey AS cust_key FROM orders WHERE o_orderkey % 7 <> 0")
def l0_first_element(spark, sf):
    df = table(spark, sf, "orders")
    bronze = bronze_rows(df, ORDER_ID, "o_orderdate", {"order": ("o_orderkey % 7 <> 0", [
        {"orderKey": "o_orderkey"}, {"orderKey": "-1"}])}, l0={"custKey": "o_custkey"})
    tree = AutoTree("order", "order", l0_array="first")
    return flatten(bronze, tree)["order"].select("order_key", "cust_key")


@query("same_leaf_names", """
SELECT c_custkey AS cust_key, c_nationkey AS v, 'home' AS side FROM customer UNION ALL
SELECT c_custkey, c_nationkey + 100, 'away' FROM customer""")
def same_leaf_names(spark, sf):
    df = table(spark, sf, "customer")
    bronze = bronze_rows(df, "concat('c_', c_custkey)", "timestamp'2024-01-01'", {"c": ("true", {
        "custKey": "c_custkey", "home": {"stat": [{"v": "c_nationkey"}]},
        "away": {"stat": [{"v": "c_nationkey + 100"}]}})})
    out = flatten(bronze, AutoTree("c", "c", keys={"c": ("cust_key",)}))
    parts = [out[f"c_{side}_stat"].select("cust_key", "v", F.lit(side).alias("side")) for side in ("home", "away")]
    return R.union_by_name(*parts)


@query("scalar_arrays_exploded", """
SELECT s_suppkey AS supp_key, v AS value FROM supplier, (SELECT unnest([1, 2]) AS i) i,
LATERAL (SELECT CASE i.i WHEN 1 THEN s_name ELSE CAST(s_nationkey AS varchar) END AS v)""")
def scalar_arrays_exploded(spark, sf):
    df = table(spark, sf, "supplier")
    bronze = bronze_rows(df, "concat('s_', s_suppkey)", "timestamp'2024-01-01'", {"s": ("true", {
        "suppKey": "s_suppkey", "tags": ["s_name", "cast(s_nationkey as string)"]})})
    out = flatten(bronze, AutoTree("s", "s", keys={"s": ("supp_key",)}, scalar_arrays="explode"))
    return out["tags"].select("supp_key", "value")


@query("scalar_arrays_kept_nested", """
SELECT s_suppkey AS supp_key, '["' || s_name || '","x"]' AS tags, '[' || s_nationkey || ',1]' AS info_deep_codes FROM supplier""")
def scalar_arrays_kept_nested(spark, sf):
    df = table(spark, sf, "supplier")
    bronze = bronze_rows(df, "concat('s_', s_suppkey)", "timestamp'2024-01-01'", {"s": ("true", {
        "suppKey": "s_suppkey", "tags": ["s_name", "'x'"], "info": {"deep": {"codes": ["s_nationkey", "1"]}}})})
    out = flatten(bronze, AutoTree("s", "s", keys={"s": ("supp_key",)}, scalar_arrays="keep"))
    return out["s"].select("supp_key", "tags", "info_deep_codes")


@query("bronze_scope", """
SELECT o_orderkey AS order_key FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997""")
def bronze_scope(spark, sf):
    df = select_element(order_bronze(spark, sf), "order")
    cond = scope_filter("orders_{competition_id}_{season}", {"competition_id": "F", "season": "1997"})
    return df.filter(cond).select(F.element_at(F.split("ingested_from", "_"), -1).cast("long").alias("order_key"))


@query("bronze_window", f"""
SELECT {ID_SQL} AS ingested_from, o_orderdate AS ingested_at FROM orders
WHERE o_orderdate > TIMESTAMP '1996-02-01' AND o_orderdate <= TIMESTAMP '1997-02-01'
  AND (o_orderstatus = 'O')""")
def bronze_window(spark, sf):
    df = select_element(order_bronze(spark, sf), "order")
    cond = all_of(scope_filter("orders_{competition_id}", {"competition_id": "O"}),
                  window_filter("1996-02-01 00:00:00", "1997-02-01 00:00:00"))
    return plain_time(df.filter(cond).select("ingested_from", "ingested_at"))


@query("select_elements", """
SELECT 'order' AS l1element, count(*) AS n FROM orders UNION ALL
SELECT 'empty', count(*) FROM orders WHERE o_orderkey % 5 = 0""")
def select_elements(spark, sf):
    return select_element(order_bronze(spark, sf), "order", "empty").groupBy("l1element").agg(
        F.count(F.lit(1)).alias("n"))


@query("coerce_single_object", "SELECT o_orderkey AS order_key, o_orderkey % 4 AS n_items FROM orders")
def coerce_single_object(spark, sf):
    df = select_element(orders_unwrapped(spark, sf), "order")
    one = df.select(F.explode(as_list("payload")).alias("o"))
    return one.select(get("o", "orderKey", as_type="bigint").alias("order_key"),
                      F.size(as_list("o", "lineItems", "lineItem")).cast("long").alias("n_items"))


@query("empty_array_no_rows", """
SELECT o_orderkey AS order_key FROM orders WHERE o_orderkey % 4 <> 0""")
def empty_array_no_rows(spark, sf):
    tree = AutoTree("order", "order", force_list=frozenset({"lineItem"}), keys={"order": ("order_key",)})
    return flatten(orders_unwrapped(spark, sf), tree)["line_item"].select("order_key").distinct()


@query("null_payloads_dropped", "SELECT count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0")
def null_payloads_dropped(spark, sf):
    df = table(spark, sf, "orders")
    bronze = bronze_rows(df, ORDER_ID, "o_orderdate", {"o": ("true", Either(
        "o_orderkey % 5 = 0", None, {"k": "o_orderkey"}))})
    return bronze.filter(present("payload")).agg(F.count(F.lit(1)).alias("n"))


@query("scalar_extraction", "SELECT event_id, CAST(props->>'k' AS bigint) AS k, CAST(NULL AS double) AS missing FROM events")
def scalar_extraction(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.parse_json("props").alias("v"))
    return df.select("event_id", get("v", "k", as_type="bigint").alias("k"), get("v", "x", as_type="double").alias("missing"))


@query("tolerant_parse", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(props->>'k' AS bigint) END AS k FROM events""")
def tolerant_parse(spark, sf):
    df = table(spark, sf, "events").withColumn(
        "props", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("{bad"), "props")))
    return df.select("event_id", get(F.try_parse_json("props"), "k", as_type="bigint").alias("k"))


@query("json_text", "SELECT event_id, '{\"k\":' || (props->>'k') || '}' AS json FROM events")
def json_text(spark, sf):
    return table(spark, sf, "events").select("event_id", F.parse_json("props").cast("string").alias("json"))


@query("path_profile", """
SELECT '$' AS path, 'object' AS kind, count(*) AS n_rows, CAST(0 AS bigint) AS n_null FROM orders UNION ALL
SELECT '$.id', 'scalar', count(*), 0 FROM orders UNION ALL
SELECT '$.item', 'object', count(*), 0 FROM orders WHERE o_orderkey % 2 = 0 UNION ALL
SELECT '$.item', 'array', count(*), 0 FROM orders WHERE o_orderkey % 2 = 1 UNION ALL
SELECT '$.item.n', 'scalar', count(*), 0 FROM orders WHERE o_orderkey % 2 = 0 UNION ALL
SELECT '$.item[]', 'object', 2 * count(*), 0 FROM orders WHERE o_orderkey % 2 = 1 UNION ALL
SELECT '$.item[].n', 'scalar', 2 * count(*), 0 FROM orders WHERE o_orderkey % 2 = 1 UNION ALL
SELECT '$.none', 'null', count(*), count(*) FROM orders""")
def path_profile(spark, sf):
    shape = {"id": "o_orderkey", "none": "cast(null as string)",
             "item": Either("o_orderkey % 2 = 0", {"n": "1"}, [{"n": "1"}, {"n": "2"}])}
    df = table(spark, sf, "orders").select(variant(shape).alias("payload"))
    return profile_paths(df, "payload", max_depth=4)


DEEP = 12


@query("path_profile_deep", " UNION ALL ".join(
    f"SELECT '${''.join(f'.l{k}' for k in range(n))}' AS path, 'object' AS kind, count(*) AS n_rows, CAST(0 AS bigint) AS n_null FROM orders" for n in range(DEEP))
       + f" UNION ALL SELECT '${''.join(f'.l{k}' for k in range(DEEP))}', 'scalar', count(*), 0 FROM orders")
def path_profile_deep(spark, sf):
    """Twelve levels, without telling the profile how many."""
    shape = "o_orderkey"
    for k in reversed(range(DEEP)):
        shape = {f"l{k}": shape}
    return profile_paths(table(spark, sf, "orders").select(variant(shape).alias("payload")), "payload")


@query("discovered_tables", """
SELECT '$.lineItems.lineItem' AS path, count(*) AS n_rows FROM orders WHERE o_orderkey % 4 <> 1 UNION ALL
SELECT '$.lineItems.lineItem[].subs.sub', sum(o_orderkey % 4) FROM orders WHERE o_orderkey % 4 > 1""")
def discovered_tables(spark, sf):
    df = table(spark, sf, "orders").select(variant(ORDER).alias("payload"))
    found = profile_paths(df, "payload").filter(F.col("kind") == "array")
    return found.select("path", "n_rows")


@query("path_profile_long_text", """
SELECT '$' AS path, 'object' AS kind, count(*) AS n_rows, CAST(0 AS bigint) AS n_null FROM documents UNION ALL
SELECT '$.body', 'scalar', count(*), 0 FROM documents UNION ALL SELECT '$.quoted', 'scalar', count(*), 0 FROM documents""")
def path_profile_long_text(spark, sf):
    """Whole texts, also with quotes, backslashes and brackets in them."""
    docs = table(spark, sf, "documents")
    return profile_paths(docs.select(variant({"body": "coalesce(text, '')", "quoted": "concat('[{', repeat('\\\\\"', 2000), text)"}).alias("payload")), "payload")


@query("path_profile_dotted", """
SELECT '$' AS path, 'object' AS kind, count(*) AS n_rows, CAST(0 AS bigint) AS n_null FROM nation UNION ALL
SELECT '$["a.b"]', 'scalar', count(*), 0 FROM nation UNION ALL
SELECT '$.a', 'object', count(*), 0 FROM nation UNION ALL
SELECT '$.a.b', 'scalar', count(*), 0 FROM nation UNION ALL
SELECT '$["' || n_name || '-"]', 'scalar', count(*), 0 FROM nation GROUP BY n_name""")
def path_profile_dotted(spark, sf):
    """A name with a dot isn't a path of two names, and names of data are quoted."""
    text_of = "concat('{\"a.b\":1,\"a\":{\"b\":2},\"', n_name, '-\":3}')"
    return profile_paths(table(spark, sf, "nation").select(F.parse_json(F.expr(text_of)).alias("payload")), "payload")


@query("field_case_variants", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 1 THEN c_nationkey END AS team_id, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS team_id_2,
       CASE WHEN c_custkey % 3 = 2 THEN c_nationkey END AS teamid, 'c.teamId AS team_id_2' AS spellings FROM customer""")
def field_case_variants(spark, sf):
    """One field in three spellings: every value is in a column, and the plan tells of the clash."""
    text_of = "concat('{\"id\":', c_custkey, ',\"', element_at(array('teamId', 'TeamId', 'teamid'), CAST(c_custkey % 3 AS int) + 1), '\":', c_nationkey, '}')"
    bronze = bronze_of_text(table(spark, sf, "customer"), text_of, "c")
    plan = discover(bronze, (AutoTree("c", "c"),), "")
    made = flatten(bronze, AutoTree("c", "c"), plan=plan)["c"]
    return made.select("id", "team_id", "team_id_2", "teamid", F.lit(", ".join(plan.spellings)).alias("spellings"))


def bronze_of_text(df, payload: str, element: str):
    """Bronze rows whose payloads are built as JSON text, where names come from the data."""
    return df.select(F.lit("src").alias("ingested_from"), F.expr("timestamp'2024-01-01'").alias("ingested_at"), F.lit(None).cast("variant").alias("l0payload"),
                     F.lit(element).alias("l1element"), F.parse_json(F.expr(payload)).alias("payload"))


@query("keyed_objects", """
SELECT c_nationkey AS nation, c_custkey::varchar AS map_key, c_mktsegment AS segment, round(c_acctbal * 100)::bigint AS cents FROM customer""")
def keyed_objects(spark, sf):
    """Customers of a nation in one object, by their ids: a table with a row per key."""
    entry = "concat('\"', c_custkey, '\":{\"segment\":\"', c_mktsegment, '\",\"cents\":', CAST(round(c_acctbal * 100) AS bigint), '}')"
    nations = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.concat_ws(",", F.collect_list(F.expr(entry))).alias("entries"))
    bronze = bronze_of_text(nations, "concat('{\"nation\":', c_nationkey, ',\"byCustomer\":{', entries, '}}')", "n")
    tree = AutoTree("n", "n", keys={"n": ("nation",), "byCustomer": ("nation", "map_key")})
    made = flatten(bronze, tree)["by_customer"]
    return made.select("nation", "map_key", "segment", "cents")


@query("event_attribute_profile", """
SELECT '$' AS path, 'object' AS kind, count(*) AS n_rows, CAST(0 AS bigint) AS n_null FROM events UNION ALL
SELECT '$.k', 'scalar', count(*), 0 FROM events""")
def event_attribute_profile(spark, sf):
    return profile_paths(table(spark, sf, "events").select(F.parse_json("props").alias("p")), "p", 3)


def part_attributes(spark, sf):
    """Numbered keys, with gaps: attr2 only for even parts, attr10 for every fifth."""
    base = {"attr1": {"_text": "p_brand"}, "attr3": {"_text": "cast(null as string)"}, "other": {"_text": "'x'"}}
    even = {**base, "attr2": {"_text": "p_type"}}
    shape = Either("p_partkey % 10 = 0", [{**even, "attr10": {"_text": "p_name"}}], Either("p_partkey % 2 = 0", [even], base))
    return table(spark, sf, "part").select("p_partkey", variant(shape).alias("payload"))


@query("unpivot_numbered", """
SELECT p_partkey, CAST(1 AS bigint) AS attr_order, p_brand AS attr FROM part UNION ALL
SELECT p_partkey, 2, p_type FROM part WHERE p_partkey % 2 = 0 UNION ALL
SELECT p_partkey, 10, p_name FROM part WHERE p_partkey % 10 = 0""")
def unpivot_numbered(spark, sf):
    return R.unpivot_numbered(part_attributes(spark, sf), "payload", "attr", ("_text",), "attr_order", "attr")


@query("max_key_number", "SELECT max(CASE WHEN p_partkey % 10 = 0 THEN 10 ELSE 3 END)::bigint AS max_number FROM part")
def max_key_number(spark, sf):
    return R.max_number(part_attributes(spark, sf), "payload", "attr")


def order_stats(spark, sf):
    node = {"n": "o_orderkey % 100", "status": "o_orderstatus"}
    shape = Either("o_orderkey % 2 = 0", {"open": node, "total": {"n": "o_custkey", "status": "'T'"}, "average": {}},
                   {"total": {"n": "o_custkey", "status": "'T'"}})
    return table(spark, sf, "orders").select("o_orderkey", variant(shape).alias("payload"))


@query("unpivot_named_structs", """
SELECT o_orderkey, 'open' AS stat_type, CAST(o_orderkey % 100 AS varchar) AS n, o_orderstatus AS status
FROM orders WHERE o_orderkey % 2 = 0 UNION ALL
SELECT o_orderkey, 'total', CAST(o_custkey AS varchar), 'T' FROM orders""")
def unpivot_named_structs(spark, sf):
    return R.unpivot_named(order_stats(spark, sf), "payload",
                           {"open": ("open",), "total": ("total",), "average": ("average",)}, "stat_type",
                           {"n": "n", "status": "status"})


@query("two_period_lists", """
SELECT l_orderkey, CASE WHEN i.i <= 2 THEN 1 ELSE 2 END AS period, l_partkey * 10 + i.i AS v, l_returnflag AS f
FROM lineitem, (SELECT unnest([1, 2, 3]) AS i) i""")
def two_period_lists(spark, sf):
    shape = {"first": {"stat": [{"v": "l_partkey * 10 + 1", "f": "l_returnflag"},
                                {"v": "l_partkey * 10 + 2", "f": "l_returnflag"}]},
             "second": {"stat": {"v": "l_partkey * 10 + 3", "f": "l_returnflag"}}}
    df = table(spark, sf, "lineitem").select("l_orderkey", variant(shape).alias("payload"))
    rows = R.unpivot_lists(df, "payload", {1: ("first", "stat"), 2: ("second", "stat")}, "period",
                           "struct<v:bigint,f:string>")
    return rows.select("l_orderkey", "period", "entry.v", "entry.f")


@query("fixed_schema_parse", """
SELECT l_orderkey, CAST(l_partkey AS varchar) AS si, l_linestatus AS sn FROM lineitem""")
def fixed_schema_parse(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", F.to_json(F.array(F.struct(
        F.col("l_partkey").cast("string").alias("SI"), F.col("l_linestatus").alias("SN")))).alias("json"))
    rows = df.select("l_orderkey", F.explode(F.from_json("json", "array<struct<SI:string,SN:string>>")).alias("s"))
    return rows.select("l_orderkey", F.col("s.SI").alias("si"), F.col("s.SN").alias("sn"))


@query("inline_prefix", """
SELECT o_orderkey AS order_key, o_orderkey % 10 AS score_points, o_orderkey % 3 AS score_tries,
       CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS on_player_id, o_custkey + 1 AS off_player_id FROM orders""")
def inline_prefix(spark, sf):
    base = {"orderKey": "o_orderkey", "score": {"points": "o_orderkey % 10", "tries": "o_orderkey % 3"},
            "off": {"playerId": "o_custkey + 1"}}
    shape = Either("o_orderkey % 2 = 0", {**base, "on": {"playerId": "o_custkey"}}, base)
    bronze = bronze_rows(table(spark, sf, "orders"), ORDER_ID, "o_orderdate", {"o": ("true", shape)})
    tree = AutoTree("o", "o", flatten_structs={"score": "score_", "on": "on_", "off": "off_"})
    return flatten(bronze, tree)["o"].drop("ingested_at", "ingested_from")


@query("context_from_id", """
SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS varchar) AS season, CAST(o_orderkey AS varchar) AS last,
       CAST(NULL AS varchar) AS beyond FROM orders""")
def context_from_id(spark, sf):
    df = select_element(order_bronze(spark, sf), "order")
    return R.context_from_id(df, "ingested_from", {"status": 1, "season": 2, "last": -1, "beyond": 9}).select(
        "status", "season", "last", "beyond")


@query("wrapper_or_self", "SELECT o_orderkey AS order_key FROM orders")
def wrapper_or_self(spark, sf):
    df = select_element(order_bronze(spark, sf), "order")
    one = df.select(F.explode(as_list(unwrap_or_self("payload", "order"))).alias("o"))
    return one.select(get("o", "orderKey", as_type="bigint").alias("order_key"))


@query("fallback_value", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'l0' WHEN o_orderkey % 3 = 1 THEN 'own' ELSE 'first' END AS source
FROM orders""")
def fallback_value(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, variant({"id": "'l0'"})).alias("l0payload"),
        variant(Either("o_orderkey % 3 = 1", {"id": "'own'"}, [{"id": "'first'"}])).alias("payload"))
    return df.select("o_orderkey", F.coalesce(
        F.nullif(get("l0payload", "id", as_type="string"), F.lit("")), get("payload", "id", as_type="string"),
        get("payload", 0, "id", as_type="string")).alias("source"))


@query("text_node_unwrap", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def text_node_unwrap(spark, sf):
    shape = {"s": Either("c_custkey % 3 = 0", {"#text": "c_mktsegment"},
                         Either("c_custkey % 3 = 1", {"_text": "c_mktsegment"}, "c_mktsegment"))}
    df = table(spark, sf, "customer").select("c_custkey", variant(shape).alias("v"))
    return df.select("c_custkey", text_node(get("v", "s")).alias("segment"))


@query("scalar_only_attributes", """
SELECT s_suppkey, 'name' AS attr, s_name AS value FROM supplier UNION ALL
SELECT s_suppkey, 'nation', CAST(s_nationkey AS varchar) FROM supplier""")
def scalar_only_attributes(spark, sf):
    shape = {"name": "s_name", "nation": "s_nationkey", "nested": {"x": "1"}, "list": ["1"], "none": "cast(null as string)"}
    df = table(spark, sf, "supplier").select("s_suppkey", variant(shape).alias("payload"))
    return R.long_attributes(df, "payload", ["s_suppkey"])


@query("wide_attributes", "SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS varchar) AS nation FROM supplier")
def wide_attributes(spark, sf):
    return R.wide_attributes(scalar_only_attributes(spark, sf), ["s_suppkey"], ["name", "nation"])


@query("mixed_kind_scalar", """
SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_name END AS value FROM nation""")
def mixed_kind_scalar(spark, sf):
    shape = {"x": Either("n_nationkey % 3 = 0", "n_name", Either("n_nationkey % 3 = 1", {"y": "1"}, ["1"]))}
    df = table(spark, sf, "nation").select("n_nationkey", variant(shape).alias("v"))
    return df.select("n_nationkey", scalar_text(get("v", "x")).alias("value"))


@query("key_union_text", """
SELECT CAST(c_custkey AS varchar) AS id, c_mktsegment AS segment, CAST(NULL AS varchar) AS nation FROM customer UNION ALL
SELECT CAST(s_suppkey AS varchar), NULL, CAST(s_nationkey AS varchar) FROM supplier""")
def key_union_text(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return R.text_columns(R.union_by_name(c, s))


@query("snake_case_names", """
SELECT p_partkey, lower(regexp_replace(regexp_replace(n, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'),
       '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')) AS column_name
FROM (SELECT p_partkey, 'p' || p_type || 'Size' || p_size || 'ID' || replace(p_brand, '#', 'URLCode') AS n FROM part)""")
def snake_case_names(spark, sf):
    name = F.concat(F.lit("p"), "p_type", F.lit("Size"), "p_size", F.lit("ID"),
                    F.replace("p_brand", F.lit("#"), F.lit("URLCode")))
    return table(spark, sf, "part").select("p_partkey", snake_case_column(name).alias("column_name"))


@query("audit_keys", """
SELECT concat_ws('_', 'orders', nullif(o_orderstatus, 'P'), CAST(year(o_orderdate) AS varchar)) AS audit_key,
       count(*) AS n FROM orders GROUP BY 1""")
def audit_keys(spark, sf):
    df = table(spark, sf, "orders")
    key = audit_key("orders", F.nullif("o_orderstatus", F.lit("P")), F.year("o_orderdate").cast("string"))
    return df.groupBy(key.alias("audit_key")).agg(F.count(F.lit(1)).alias("n"))


@query("lineage_columns", """
SELECT n_nationkey, 'bronze' AS source_schema, 'nation' AS source_table_name, 'flat' AS target_schema,
       'nation_flat' AS target_table_name FROM nation""")
def lineage_columns(spark, sf):
    return stamp_lineage(table(spark, sf, "nation").select("n_nationkey"), "lake.bronze.nation", "lake.flat.nation_flat")


@query("conversation_turns", "SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations")
def conversation_turns(spark, sf):
    shape = {"convId": "conv_id", "turns": {"turn": Either(
        "turn % 2 = 0", {"turnId": "turn", "who": "role", "text": "text"},
        [{"turnId": "turn", "who": "role", "text": "text"}])}}
    bronze = bronze_rows(table(spark, sf, "conversations"), "concat('conv_', conv_id, '_', turn)",
                         "timestamp'2024-01-01'", {"conv": ("true", shape)})
    tree = AutoTree("conv", "conv", force_list=frozenset({"turn"}), keys={"conv": ("conv_id",)})
    rows = flatten(bronze, tree)["turn"]
    return rows.select("conv_id", F.col("turn_id").alias("turn"), F.col("who").alias("role"),
                       F.length("text").cast("long").alias("n_chars"))
